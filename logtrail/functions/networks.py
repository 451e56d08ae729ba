"""Network owner, network type, distance and disagreement of two geo sources."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logtrail.functions.useragents import contains_any

# Cloud tokens looked for in the provider, scanner tokens in the whole owner text.
CLOUD_TOKENS = [
    "amazon", "aws", "google cloud", "google llc", "microsoft", "azure", "digitalocean", "digital ocean",
    "oracle cloud", "alibaba", "tencent", "ovh", "hetzner", "linode", "akamai connected cloud", "vultr",
    "scaleway", "ibm cloud", "contabo",
]
SCANNER_NETWORK_TOKENS = [
    "palo alto networks", "censys", "shodan", "internet-wide scan", "internet wide scan", "stretchoid",
    "binaryedge", "leakix", "rapid7", "onyphe", "netsystemsresearch", "security research",
]

# Mean Earth radius and the limits of the severity classes, in km.
EARTH_RADIUS_KM = 6371.0
HIGH_KM = 500
MEDIUM_KM = 100

_ASN = r"\A(AS[0-9]+)\s*([^\n]*)\z"


def org_asn(org: Column) -> Column:
    return F.regexp_extract(F.trim(F.coalesce(org, F.lit(""))), _ASN, 1)


def org_provider(org: Column) -> Column:
    """Owner name after the AS number; the whole text when there is no number."""
    text = F.trim(F.coalesce(org, F.lit("")))
    return F.when(text.rlike(_ASN), F.trim(F.regexp_extract(text, _ASN, 2))).otherwise(text)


def asn_org(number: Column, name: Column) -> Column:
    """`AS<number> <name>`, the name alone when there is no number."""
    name = F.coalesce(name, F.lit(""))
    has_number = F.coalesce(number, F.lit(0)) != 0
    return F.when(has_number, F.trim(F.concat(F.lit("AS"), number.cast("string"), F.lit(" "), name))).otherwise(name)


def is_cloud_provider(provider: Column) -> Column:
    return contains_any(F.lower(provider), CLOUD_TOKENS)


def is_known_scanner_network(org: Column) -> Column:
    return contains_any(F.lower(org), SCANNER_NETWORK_TOKENS)


def network_type(org: Column, provider: Column, has_geo: Column) -> Column:
    return (
        F.when(~has_geo, "")
        .when(is_known_scanner_network(org), "scanner")
        .when(is_cloud_provider(provider), "cloud")
        .otherwise("residencial")
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null when a coordinate is null."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(1.0) - a, F.lit(0.0))))


def divergence_severity(distance_km: Column, country_differs: Column) -> Column:
    return (
        F.when(country_differs, "alta")
        .when(distance_km.isNull(), "")
        .when(distance_km > HIGH_KM, "alta")
        .when(distance_km > MEDIUM_KM, "media")
        .otherwise("baixa")
    )


def location_part(location: Column, index: int) -> Column:
    """Part 1 (latitude) or 2 (longitude) of a `lat,lon` text; both null when either is bad."""
    lat = F.split_part(location, F.lit(","), F.lit(1)).try_cast("double")
    lon = F.regexp_extract(location, r"(?s)\A[^,]*,(.*)\z", 1).try_cast("double")
    both = lat.isNotNull() & lon.isNotNull()
    return F.when(both, lat if index == 1 else lon)
