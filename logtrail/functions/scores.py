"""Risk and human-likelihood scores, and request indicators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logtrail.functions.identity import map_value

# Paths only scanners ask for, weights of the risk score and its caps.
SCANNER_PATH = r"\.env|\.git|wp-admin"
RISK_WEIGHTS = {
    "scanner_network": 50,
    "scanner_user_agent": 40,
    "scanner_path": 30,
    "other_method": 25,
    "wrong_host": 50,
    "cloud_alone": 35,
    "no_browser_headers": 25,
}
RISK_CAP = 100
RISK_CAP_PREVIEW = 10

# Base, forced values and adjustments of the human likelihood.
HUMAN_BASE = 0.5
HUMAN_PREVIEW = 0.05
HUMAN_ADJUSTMENTS = {
    "language": 0.20,
    "user_click": 0.15,
    "residential": 0.15,
    "real_browser": 0.20,
    "cloud": -0.30,
    "no_language": -0.20,
    "no_fetch_headers": -0.15,
}
REAL_BROWSERS = ["chrome", "safari", "firefox"]

# Meaning of the sec-fetch-site header.
FETCH_SITE_MEANINGS = {
    "none": "Navegação direta, sem página de origem",
    "same-origin": "Mesma origem",
    "same-site": "Mesmo site, origens diferentes",
    "cross-site": "Outro site",
}


def no_fetch_headers() -> Column:
    fields = ["sec_fetch_dest", "sec_fetch_mode", "sec_fetch_site", "sec_fetch_user"]
    return F.concat(*[F.col(name) for name in fields]) == ""


def is_scanner_path(path: Column) -> Column:
    return F.lower(path).rlike(SCANNER_PATH)


def suspicion_score(site_host: str) -> Column:
    """0..100 from a Silver row. The cloud weight counts only when no other signal does."""
    signals = {
        "scanner_network": F.col("is_known_scanner_network"),
        "scanner_user_agent": F.col("is_scanner_user_agent"),
        "scanner_path": is_scanner_path(F.col("raw_path")),
        "other_method": F.col("method") != "GET",
        "wrong_host": F.col("host") != site_host,
        "no_browser_headers": (F.col("accept_language") == "") & no_fetch_headers(),
    }
    weighted = [F.when(signal, RISK_WEIGHTS[name]).otherwise(0) for name, signal in signals.items()]
    others = sum(weighted[1:], weighted[0])
    cloud = F.when(F.col("is_cloud_provider") & (others == 0), RISK_WEIGHTS["cloud_alone"]).otherwise(0)
    cap = F.when(F.col("is_social_preview"), RISK_CAP_PREVIEW).otherwise(RISK_CAP)
    return F.least(others + cloud, cap)


def human_probability() -> Column:
    """0..1 from a Silver row."""
    signals = {
        "language": F.col("accept_language") != "",
        "user_click": F.col("sec_fetch_user") == "?1",
        "residential": F.col("network_type") == "residencial",
        "real_browser": F.col("browser_family").isin(REAL_BROWSERS),
        "cloud": F.col("is_cloud_provider"),
        "no_language": F.col("accept_language") == "",
        "no_fetch_headers": no_fetch_headers(),
    }
    total = F.lit(HUMAN_BASE)
    for name, signal in signals.items():
        total = total + F.when(signal, HUMAN_ADJUSTMENTS[name]).otherwise(0.0)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))
    return (
        F.when(F.col("is_scanner_user_agent") | F.col("is_known_scanner_network"), 0.0)
        .when(F.col("is_social_preview"), HUMAN_PREVIEW)
        .otherwise(F.round(clamped, 2))
    )


def fetch_site_meaning(value: Column) -> Column:
    return map_value(value, FETCH_SITE_MEANINGS, "")


def forwarded_count(forwarded: Column) -> Column:
    return F.when(forwarded == "", 0).otherwise(F.size(F.split(forwarded, ",")))


def forwarded_mismatch(forwarded: Column, ip: Column) -> Column:
    """More than one address, or a first address other than the visitor's."""
    first = F.trim(F.split_part(forwarded, F.lit(","), F.lit(1)))
    return (forwarded != "") & ((forwarded_count(forwarded) > 1) | (first != ip))


def odd_query(query: Column) -> Column:
    """Characters no ordinary campaign parameter has."""
    return query.rlike(r"[^A-Za-z0-9_.~%&=+:,/@-]")
