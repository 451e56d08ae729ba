"""Signature rules of the license scan, and the keywords that admit them.

A rule is: label; priority; confidence; pattern. Patterns are written for text in
lower case whose words (letters, digits, non-ASCII) are joined by one space. Rules
stand in the block of their keyword, a word that every match of the rule holds.
A higher priority wins where one detection holds another.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


# Priorities: 4 identifier with version, 3 full name with version, 2 name, 1 phrase of a text, 0 generic.
_SOURCE = r"""
[gnu]
gpl-3.0-or-later|4|1.0|gnu general public license (as published by the free software foundation )?(either )?(version|v) ?3( 0)?( of the license)? (or|and) (at your option )?any later version
gpl-2.0-or-later|4|1.0|gnu general public license (as published by the free software foundation )?(either )?(version|v) ?2( 0)?( of the license)? (or|and) (at your option )?any later version
gpl-3.0|3|0.98|gnu general public license (version|v) ?3( 0)?
gpl-2.0|3|0.98|gnu general public license (version|v) ?2( 0)?
gpl-1.0|3|0.98|gnu general public license (version|v) ?1( 0)?
gpl-3.0|3|0.95|version 3 of the gnu general public license
gpl-2.0|3|0.95|version 2 of the gnu general public license
gpl|2|0.9|gnu general public licen[cs]e
lgpl-3.0|3|0.98|gnu (lesser|library) general public license (version|v) ?3( 0)?
lgpl-2.1|3|0.98|gnu (lesser|library) general public license (version|v) ?2 1
lgpl-2.0|3|0.98|gnu (lesser|library) general public license (version|v) ?2( 0)?
lgpl-3.0|3|0.95|version 3 of the gnu lesser general public license
lgpl-2.1|3|0.95|version 2 1 of the gnu lesser general public license
lgpl|2|0.9|gnu (lesser|library) general public licen[cs]e
agpl-3.0|3|0.98|gnu affero general public license (version|v) ?3( 0)?
agpl-3.0|3|0.95|version 3 of the gnu affero general public license
agpl|2|0.9|gnu affero general public licen[cs]e
gfdl-1.3|3|0.98|gnu free documentation license (version|v) ?1 3
gfdl-1.2|3|0.98|gnu free documentation license (version|v) ?1 2
gfdl-1.1|3|0.98|gnu free documentation license (version|v) ?1 1
gfdl|2|0.9|gnu free documentation licen[cs]e
gpl-classpath|4|0.98|gnu general public license (version 2 )?with (the )?(gnu )?classpath exception
gnu-all-permissive|2|0.8|gnu all permissive license
gpl|1|0.7|gnu gpl
lgpl|1|0.7|gnu lgpl
agpl|1|0.7|gnu agpl
gpl|1|0.8|www gnu org licenses gpl( html| txt)?
lgpl|1|0.8|www gnu org licenses lgpl( html| txt)?
agpl|1|0.8|www gnu org licenses agpl( html| txt)?
gfdl|1|0.8|www gnu org licenses fdl( html| txt)?
[gpl]
gpl-3.0-or-later|4|1.0|spdx license identifier gpl 3 0 or later
gpl-3.0|4|1.0|spdx license identifier gpl 3 0( only)?
gpl-2.0-or-later|4|1.0|spdx license identifier gpl 2 0 or later
gpl-2.0|4|1.0|spdx license identifier gpl 2 0( only)?
gpl-3.0|3|0.9|gpl (version|v) ?3( 0)?
gpl-2.0|3|0.9|gpl (version|v) ?2( 0)?
gpl|1|0.7|(under|by) the (terms of the )?gpl
[gplv3]
gpl-3.0|3|0.9|gplv3( or later)?
[gplv2]
gpl-2.0|3|0.9|gplv2( or later)?
[lgpl]
lgpl-3.0|4|1.0|spdx license identifier lgpl 3 0( only| or later)?
lgpl-2.1|4|1.0|spdx license identifier lgpl 2 1( only| or later)?
lgpl-2.0|4|1.0|spdx license identifier lgpl 2 0( only| or later)?
lgpl-3.0|3|0.9|lgpl (version|v) ?3( 0)?
lgpl-2.1|3|0.9|lgpl (version|v) ?2 1
lgpl|1|0.7|(under|by) the (terms of the )?lgpl
[agpl]
agpl-3.0|4|1.0|spdx license identifier agpl 3 0( only| or later)?
agpl-3.0|3|0.9|agpl (version|v) ?3( 0)?
agpl|1|0.7|(under|by) the (terms of the )?agpl
[agplv3]
agpl-3.0|3|0.9|agplv3
[affero]
agpl-1.0|3|0.95|affero general public license (version|v) ?1( 0)?
agpl|2|0.8|affero general public license
[apache]
apache-2.0|4|1.0|spdx license identifier apache 2 0
apache-1.1|4|1.0|spdx license identifier apache 1 1
apache-1.0|4|1.0|spdx license identifier apache 1 0
apache-2.0|3|0.98|apache license (version|v) ?2( 0)?
apache-1.1|3|0.98|apache (software )?license (version|v) ?1 1
apache-1.0|3|0.98|apache (software )?license (version|v) ?1 0
apache-2.0|3|0.9|apache 2( 0)? licen[cs]e
apache-2.0|3|0.9|www apache org licenses license 2 0( html| txt)?
apache|2|0.85|apache (software )?licen[cs]e
apache|1|0.6|www apache org licenses
[asl]
apache-2.0|1|0.6|asl (version |v)?2( 0)?
[mit]
mit|4|1.0|spdx license identifier mit
mit-0|4|1.0|spdx license identifier mit 0
mit|2|0.95|(the )?mit licen[cs]e
mit-0|3|0.95|mit no attribution( license)?
mit|2|0.85|(released|licensed|distributed|available) under (the )?(terms of the )?mit
mit|1|0.8|opensource org licenses mit( license)?( php| html)?
mit-modern|3|0.9|mit license modern variant
[expat]
mit|2|0.9|expat licen[cs]e
[x11]
x11|2|0.9|x11 licen[cs]e
x11|4|1.0|spdx license identifier x11
[permission]
mit|1|0.75|permission is hereby granted free of charge to any person obtaining a copy
isc|1|0.75|permission to use copy modify and or distribute this software for any purpose
historical|1|0.6|permission to use copy modify and distribute this software and its documentation
restricted|1|0.6|without (the )?(prior |express |prior written |written )+permission
[royalty]
all-permissive|1|0.6|copying and distribution of this file with or without modification are permitted in any medium without royalty
[cc]
cc-by-nc-nd-4.0|4|1.0|cc by nc nd 4 0
cc-by-nc-nd-3.0|4|1.0|cc by nc nd 3 0
cc-by-nc-sa-4.0|4|1.0|cc by nc sa 4 0
cc-by-nc-sa-3.0|4|1.0|cc by nc sa 3 0
cc-by-nc-4.0|4|1.0|cc by nc 4 0
cc-by-nc-3.0|4|1.0|cc by nc 3 0
cc-by-nc-2.0|4|1.0|cc by nc 2 0
cc-by-nd-4.0|4|1.0|cc by nd 4 0
cc-by-nd-3.0|4|1.0|cc by nd 3 0
cc-by-sa-4.0|4|1.0|cc by sa 4 0
cc-by-sa-3.0|4|1.0|cc by sa 3 0
cc-by-sa-2.5|4|1.0|cc by sa 2 5
cc-by-sa-2.0|4|1.0|cc by sa 2 0
cc-by-4.0|4|1.0|cc by 4 0
cc-by-3.0|4|1.0|cc by 3 0
cc-by-2.5|4|1.0|cc by 2 5
cc-by-2.0|4|1.0|cc by 2 0
cc-by-nc-nd|2|0.9|cc by nc nd
cc-by-nc-sa|2|0.9|cc by nc sa
cc-by-nc|2|0.9|cc by nc
cc-by-nd|2|0.9|cc by nd
cc-by-sa|2|0.9|cc by sa
cc-by|1|0.85|cc by
[cc0]
cc0-1.0|4|1.0|cc0 1 0( universal)?
cc0-1.0|2|0.9|cc0
[creative]
cc-by-nc-nd-4.0|3|0.98|creative commons attribution non ?commercial no ?deriv(s|atives) 4 0
cc-by-nc-sa-4.0|3|0.98|creative commons attribution non ?commercial share ?alike 4 0
cc-by-nc-4.0|3|0.98|creative commons attribution non ?commercial 4 0
cc-by-sa-4.0|3|0.98|creative commons attribution share ?alike 4 0
cc-by-sa-3.0|3|0.98|creative commons attribution share ?alike 3 0
cc-by-nd-4.0|3|0.98|creative commons attribution no ?deriv(s|atives) 4 0
cc-by-4.0|3|0.98|creative commons attribution 4 0
cc-by-3.0|3|0.98|creative commons attribution 3 0
cc-by-nc-nd|2|0.9|creative commons attribution non ?commercial no ?deriv(s|atives)
cc-by-nc-sa|2|0.9|creative commons attribution non ?commercial share ?alike
cc-by-nc|2|0.9|creative commons attribution non ?commercial
cc-by-sa|2|0.9|creative commons attribution share ?alike
cc-by-nd|2|0.9|creative commons attribution no ?deriv(s|atives)
cc-by|1|0.85|creative commons attribution
cc0-1.0|2|0.9|creative commons (cc0|zero)( 1 0)?
creative-commons|0|0.5|creative commons( licen[cs]e)?
[creativecommons]
cc-by-nc-nd-4.0|4|1.0|creativecommons org licenses by nc nd 4 0
cc-by-nc-sa-4.0|4|1.0|creativecommons org licenses by nc sa 4 0
cc-by-nc-4.0|4|1.0|creativecommons org licenses by nc 4 0
cc-by-nd-4.0|4|1.0|creativecommons org licenses by nd 4 0
cc-by-sa-4.0|4|1.0|creativecommons org licenses by sa 4 0
cc-by-sa-3.0|4|1.0|creativecommons org licenses by sa 3 0
cc-by-4.0|4|1.0|creativecommons org licenses by 4 0
cc-by-3.0|4|1.0|creativecommons org licenses by 3 0
cc0-1.0|4|1.0|creativecommons org publicdomain zero 1 0
cc-pdm-1.0|4|1.0|creativecommons org publicdomain mark 1 0
creative-commons|0|0.6|creativecommons org( licenses)?
[bsd]
bsd-3-clause|4|1.0|spdx license identifier bsd 3 clause
bsd-2-clause|4|1.0|spdx license identifier bsd 2 clause
bsd-4-clause|4|1.0|spdx license identifier bsd 4 clause
bsd-3-clause|3|0.95|(3|three) clause bsd
bsd-2-clause|3|0.95|(2|two) clause bsd
bsd-4-clause|3|0.95|(4|four) clause bsd
bsd-3-clause|3|0.95|bsd (3|three) clause( licen[cs]e)?
bsd-2-clause|3|0.95|bsd (2|two) clause( licen[cs]e)?
bsd-4-clause|3|0.95|bsd (4|four) clause( licen[cs]e)?
bsd-3-clause|3|0.95|(new|modified|revised) bsd licen[cs]e
bsd-2-clause|3|0.95|(simplified|freebsd) bsd licen[cs]e
bsd-4-clause|3|0.95|(original|old) bsd licen[cs]e
0bsd|3|0.95|bsd zero clause( licen[cs]e)?
bsd|2|0.85|bsd (style )?licen[cs]e
[0bsd]
0bsd|4|1.0|spdx license identifier 0bsd
[redistribution]
bsd|1|0.75|redistribution and use in source and binary forms with or without modification are permitted
bsd|1|0.4|redistribution and use in source and binary forms
[redistributions]
bsd|1|0.6|redistributions of source code must retain the above copyright notice
bsd|1|0.6|redistributions in binary form must reproduce the above copyright notice
[neither]
bsd-3-clause|1|0.7|neither the name of the [^ ]+( [^ ]+){0,6} nor the names of its contributors
[isc]
isc|4|1.0|spdx license identifier isc
isc|2|0.9|isc licen[cs]e
[zlib]
zlib|4|1.0|spdx license identifier zlib
zlib|2|0.9|zlib( libpng)? licen[cs]e
[libpng]
libpng|2|0.9|libpng licen[cs]e
[mozilla]
mpl-2.0|3|0.98|mozilla public license (version|v) ?2( 0)?
mpl-1.1|3|0.98|mozilla public license (version|v) ?1 1
mpl-1.0|3|0.98|mozilla public license (version|v) ?1 0
mpl-2.0|3|0.95|mozilla org mpl 2 0
mpl|2|0.9|mozilla public licen[cs]e
[mpl]
mpl-2.0|4|1.0|spdx license identifier mpl 2 0
mpl-1.1|4|1.0|spdx license identifier mpl 1 1
mpl-2.0|3|0.9|mpl (version |v)?2( 0)?
mpl-1.1|3|0.9|mpl (version |v)?1 1
[eclipse]
epl-2.0|3|0.98|eclipse public license (version |v)?2( 0)?
epl-1.0|3|0.98|eclipse public license (version |v)?1( 0)?
edl-1.0|3|0.98|eclipse distribution license (version |v)?1( 0)?
epl|2|0.9|eclipse public licen[cs]e
edl|2|0.9|eclipse distribution licen[cs]e
[epl]
epl-2.0|4|1.0|spdx license identifier epl 2 0
epl-1.0|4|1.0|spdx license identifier epl 1 0
epl-2.0|3|0.85|epl (version |v)?2( 0)?
[cddl]
cddl-1.1|4|1.0|spdx license identifier cddl 1 1
cddl-1.0|4|1.0|spdx license identifier cddl 1 0
cddl|2|0.8|cddl( licen[cs]e)?
[distribution]
cddl-1.1|3|0.98|common development and distribution license (version |v)?1 1
cddl-1.0|3|0.98|common development and distribution license (version |v)?1 0
cddl|2|0.9|common development and distribution licen[cs]e
[common]
cpl-1.0|2|0.9|common public license( (version |v)?1 0)?
cpal-1.0|2|0.9|common public attribution license( (version |v)?1 0)?
[eupl]
eupl-1.2|3|0.95|eupl (version |v)?1 2
eupl-1.1|3|0.95|eupl (version |v)?1 1
eupl|2|0.8|eupl
[union]
eupl-1.2|3|0.98|european union public licen[cs]e (version |v)?1 2
eupl|2|0.9|european union public licen[cs]e
[boost]
bsl-1.0|3|0.98|boost software license (version |v)?1 0
bsl-1.0|2|0.9|boost software licen[cs]e
bsl-1.0|2|0.9|www boost org license 1 0( txt)?
[bsl]
bsl-1.0|4|1.0|spdx license identifier bsl 1 0
[business]
busl-1.1|3|0.95|business source license( (version |v)?1 1)?
[unlicense]
unlicense|4|1.0|spdx license identifier unlicense
unlicense|2|0.9|(the )?unlicense
[unencumbered]
unlicense|1|0.8|this is free and unencumbered software released into the public domain
[wtfpl]
wtfpl|3|0.95|wtfpl( (version |v)?2)?
[artistic]
artistic-2.0|4|1.0|spdx license identifier artistic 2 0
artistic-2.0|3|0.95|artistic license (version |v)?2( 0)?
artistic-1.0|3|0.95|artistic license (version |v)?1( 0)?
artistic|2|0.85|artistic licen[cs]e
[python]
python-2.0|3|0.95|python software foundation license( (version |v)?2)?
python-2.0|2|0.9|python licen[cs]e( (version |v)?2( 0)?)?
[psf]
python-2.0|2|0.9|psf licen[cs]e( agreement)?
[php]
php-3.01|3|0.95|php license (version |v)?3 01
php|2|0.85|php licen[cs]e
[ruby]
ruby|2|0.85|ruby licen[cs]e
[perl]
perl|2|0.8|same terms as perl( itself)?
[openssl]
openssl|2|0.9|openssl licen[cs]e
[w3c]
w3c|2|0.9|w3c software (notice and )?licen[cs]e
[unicode]
unicode-dfs|2|0.9|unicode license( agreement)?( data files and software)?
[ofl]
ofl-1.1|4|1.0|spdx license identifier ofl 1 1
[font]
ofl-1.1|3|0.95|sil open font license( (version |v)?1 1)?
ofl|2|0.85|open font licen[cs]e
[postgresql]
postgresql|2|0.9|postgresql licen[cs]e
[microsoft]
ms-pl|3|0.95|microsoft public licen[cs]e
ms-rl|3|0.95|microsoft reciprocal licen[cs]e
[academic]
afl-3.0|3|0.95|academic free license( (version |v)?3 0)?
[educational]
ecl-2.0|3|0.95|educational community license( (version |v)?2 0)?
[open]
osl-3.0|3|0.95|open software license( (version |v)?3 0)?
odbl-1.0|3|0.95|open (data commons open )?database license( (version |v)?1 0)?
odc-by-1.0|3|0.95|open data commons attribution license
ogl-3.0|3|0.95|open government licen[cs]e( (version |v)?3 0)?
[odbl]
odbl-1.0|2|0.9|odbl( 1 0)?
[cecill]
cecill-2.1|3|0.95|cecill( free software)?( licen[cs]e)?( agreement)? (version |v)?2 1
cecill|2|0.85|cecill( [bc])?
[elastic]
elastic-2.0|3|0.95|elastic license( (version |v)?2 0)?
[sspl]
sspl-1.0|3|0.95|sspl( (version |v)?1( 0)?)?
[side]
sspl-1.0|3|0.95|server side public licen[cs]e( (version |v)?1)?
[commons]
commons-clause|3|0.9|commons clause( licen[cs]e)?( condition)?
[domain]
public-domain|1|0.6|(in|into|to) the public domain
public-domain|1|0.7|dedicated to the public domain
[reserved]
all-rights-reserved|1|0.8|all rights reserved
[vorbehalten]
all-rights-reserved|1|0.7|alle rechte vorbehalten
[réservés]
all-rights-reserved|1|0.7|tous droits réservés
[reservados]
all-rights-reserved|1|0.7|todos los derechos reservados
[proprietary]
proprietary|1|0.7|(confidential and proprietary|proprietary and confidential|proprietary licen[cs]e)
[eula]
proprietary|1|0.6|eula
[license]
proprietary|1|0.6|end user license agreement
generic|0|0.3|licensed under( the)? [^ ]+( [^ ]+)? license
generic|0|0.2|license (agreement|text|terms|notice|file)
generic|0|0.2|see (the )?license( file)?( for (more )?details)?
[licence]
generic|0|0.2|(see|under) (the )?(terms of the )?licence
[warranty]
generic|0|0.3|without warranty of any kind express or implied
generic|0|0.3|without any warranty without even the implied warranty of merchantability
[copyleft]
generic|0|0.2|copyleft( licen[cs]e)?
[spdx]
generic|0|0.4|spdx license identifier [^ ]+
"""


def rules(source: str = _SOURCE) -> list[Rule]:
    """The rules in order."""
    found, keyword = [], ""
    for line in source.strip().splitlines():
        if line.startswith("["):
            keyword = line.strip("[]")
        else:
            fields = line.split("|", 3)
            found.append(Rule(fields[0], int(fields[1]), float(fields[2]), keyword, fields[3]))
    return found
