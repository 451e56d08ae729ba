"""User-agent rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Ordered family rules (tokens looked for in the lower-cased text, family).
BROWSER_RULES = [
    (["linkedinbot"], "linkedinbot"),
    (["whatsapp"], "whatsapp"),
    (["facebookexternalhit", "facebot"], "facebookbot"),
    (["twitterbot"], "twitterbot"),
    (["googlebot"], "googlebot"),
    (["edg"], "edge"),
    (["opr", "opera"], "opera"),
    (["chrome"], "chrome"),
    (["safari"], "safari"),
    (["firefox"], "firefox"),
    (["curl"], "curl"),
    (["python"], "python"),
]

# Device, scanner and social preview tokens.
MOBILE_TOKENS = ["mobile", "android", "iphone"]
SCANNER_TOKENS = [
    "curl", "wget", "zgrab", "python", "python-requests", "scrapy", "libwww", "go-http-client", "nmap",
    "masscan", "censys", "shodan", "palo alto", "paloalto", "nuclei", "httpclient", "java/",
]
SOCIAL_TOKENS = [
    "whatsapp", "linkedinbot", "facebookexternalhit", "facebot", "twitterbot", "telegrambot", "slackbot",
    "discordbot",
]


def contains_any(lowered: Column, tokens: list[str]) -> Column:
    return reduce(lambda found, token: found | lowered.contains(token), tokens[1:], lowered.contains(tokens[0]))


def browser_family(user_agent: Column) -> Column:
    lowered = F.lower(user_agent)
    tokens, family = BROWSER_RULES[0]
    rules = F.when(contains_any(lowered, tokens), family)
    for tokens, family in BROWSER_RULES[1:]:
        rules = rules.when(contains_any(lowered, tokens), family)
    return rules.otherwise("unknown")


def device_type(user_agent: Column) -> Column:
    return F.when(contains_any(F.lower(user_agent), MOBILE_TOKENS), "mobile").otherwise("desktop")


def is_scanner_user_agent(user_agent: Column) -> Column:
    return contains_any(F.lower(user_agent), SCANNER_TOKENS)


def is_social_preview(user_agent: Column, range_header: Column) -> Column:
    """A social token; with a Range header any text with `bot` counts as well."""
    lowered = F.lower(user_agent)
    return contains_any(lowered, SOCIAL_TOKENS) | ((range_header != "") & lowered.contains("bot"))
