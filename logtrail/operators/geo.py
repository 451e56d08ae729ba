"""Geolocation: distinct addresses, longest-prefix lookup, cache, enrichment, disagreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from logtrail.functions import addresses, networks
from logtrail.operators.once import compute_once, join_key
from logtrail.schemas import GEO_FIELDS, GEO_RECORD_SCHEMA

CITY_FIELDS = [name for name in GEO_FIELDS if name != "org"]
TEXT_FIELDS = ["country_code", "country_name", "city", "region", "postal_code", "timezone"]


def distinct_ips(records: DataFrame) -> DataFrame:
    """Distinct non-empty addresses; partial aggregation runs before the shuffle."""
    return records.where(F.col("ip") != "").select("ip").distinct()


def distinct_ips_in_order(records: DataFrame) -> DataFrame:
    """Distinct addresses with `position_key`, their first (log_stream, start_ts, request_id)."""
    key = F.min(F.struct("log_stream", "start_ts", "request_id")).alias("position_key")
    return records.where(F.col("ip") != "").groupBy("ip").agg(key)


def uncached_ips(ips: DataFrame, cache: DataFrame) -> DataFrame:
    return ips.join(cache.select("ip"), "ip", "left_anti")


def network_table(blocks: DataFrame) -> DataFrame:
    """Rows with `network` (CIDR text) -> the same rows keyed by family, prefix length, prefix."""
    address = F.split_part("network", F.lit("/"), F.lit(1))
    length = F.split_part("network", F.lit("/"), F.lit(2)).try_cast("int")
    return (
        blocks.withColumns({"_address_key": addresses.address_key(address), "prefix_length": length})
        .transform(compute_once, ["_address_key", "prefix_length"])
        .where(F.col("_address_key").isNotNull() & F.col("prefix_length").isNotNull())
        .withColumn("family", F.col("_address_key").substr(1, 1))
        .withColumn("prefix", addresses.masked_key(F.col("_address_key"), F.col("prefix_length")))
        .drop("_address_key")
    )


def longest_prefix_match(ips: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Each address with, per table, a struct of its most specific network's fields.

    Tables are looked up independently of each other but in one pass; a struct is
    null where nothing matched. An address yields one candidate per prefix length
    that occurs in its family (at most 33 or 129), and candidates meet networks in
    an equi-join. The work grows with addresses times lengths, whatever the
    networks' nesting or density.
    """
    table = None
    for name, blocks in tables.items():
        fields = [field for field in blocks.columns if field != "network"]
        rows = network_table(blocks).select("family", "prefix_length", "prefix", F.struct(*fields).alias(name))
        table = rows if table is None else table.unionByName(rows, allowMissingColumns=True)
    # Two rows at most, with at most 129 integers: a bound of the address format.
    lengths = table.groupBy("family").agg(F.collect_set("prefix_length").alias("lengths"))
    candidates = (
        ips.select("ip", addresses.lookup_key(F.col("ip")).alias("_key"))
        .transform(compute_once, ["_key"])
        .withColumn("family", F.col("_key").substr(1, 1))
        .join(F.broadcast(lengths), "family", "left")
        .select("ip", "_key", "family", F.explode_outer("lengths").alias("prefix_length"))
        .withColumn("prefix", addresses.masked_key(F.col("_key"), F.col("prefix_length")))
    )
    hits = candidates.join(table, ["family", "prefix_length", "prefix"], "left")
    best = [F.max_by(name, F.when(F.col(name).isNotNull(), F.col("prefix_length"))).alias(name) for name in tables]
    return hits.groupBy("ip").agg(*best)


def lookup_networks(ips: DataFrame, city_blocks: DataFrame, asn_blocks: DataFrame) -> DataFrame:
    """City and owner of each address: a geo record per address.

    An address in neither table keeps all fields null ("known, no data").
    """
    found = longest_prefix_match(
        ips,
        {
            "city_hit": city_blocks.select("network", *CITY_FIELDS),
            "asn_hit": asn_blocks.select("network", "asn_number", "asn_name"),
        },
    )
    has_city, has_asn = F.col("city_hit").isNotNull(), F.col("asn_hit").isNotNull()

    def field(name: str) -> Column:
        value = F.col(f"city_hit.{name}")
        return F.when(has_city, F.coalesce(value, F.lit(""))) if name in TEXT_FIELDS else value

    org = networks.asn_org(F.col("asn_hit.asn_number"), F.col("asn_hit.asn_name"))
    return found.select("ip", *[field(name).alias(name) for name in CITY_FIELDS], F.when(has_asn, org).alias("org"))


def extend_cache(ips: DataFrame, cache: DataFrame, city_blocks: DataFrame, asn_blocks: DataFrame) -> DataFrame:
    """Old cache plus a record for every address not in it; old records are kept as they are."""
    return cache.select(*GEO_RECORD_SCHEMA.fieldNames()).unionByName(fresh_records(ips, cache, city_blocks, asn_blocks))


def fresh_records(ips: DataFrame, cache: DataFrame, city_blocks: DataFrame, asn_blocks: DataFrame) -> DataFrame:
    """A record for every address that is not in the cache, also where no network holds it."""
    return lookup_networks(uncached_ips(ips, cache), city_blocks, asn_blocks)


def _has_any(fields: list[Column]) -> Column:
    return F.coalesce(*[F.when(field.isNotNull(), True) for field in fields], F.lit(False))


def _probe(records: DataFrame) -> Column:
    # Accesses without an address match nothing; spread them by request.
    spread = F.coalesce("request_id", F.lit("")) if "request_id" in records.columns else F.lit("")
    return F.when(F.coalesce("ip", F.lit("")) != "", F.col("ip")).otherwise(F.concat(F.lit("\u0000"), spread))


def enrich_geo(records: DataFrame, geo: DataFrame) -> DataFrame:
    """Left join by exact address, then 13 columns. `geo` has one row per address.

    A hot address is split by the adaptive skew join; a small `geo` is broadcast
    by Spark's own size check.
    """
    side = geo.select(join_key("ip").alias("_geo_ip"), *[F.col(name).alias(f"_geo_{name}") for name in GEO_FIELDS])
    joined = records.withColumn("_probe", _probe(records)).join(side, F.col("_probe") == F.col("_geo_ip"), "left")

    def text(name: str) -> Column:
        return F.coalesce(f"_geo_{name}", F.lit(""))

    has_geo = _has_any([F.col(f"_geo_{name}") for name in GEO_FIELDS])
    org = text("org")
    return (
        joined.withColumns({"geo_asn": networks.org_asn(org), "geo_provider": networks.org_provider(org)})
        .withColumns(
            {
                "geo_country_code": text("country_code"),
                "geo_country_name": text("country_name"),
                "geo_city": text("city"),
                "geo_region": text("region"),
                "geo_postal_code": text("postal_code"),
                "geo_latitude": F.col("_geo_latitude"),
                "geo_longitude": F.col("_geo_longitude"),
                "geo_timezone": text("timezone"),
                "is_cloud_provider": networks.is_cloud_provider(F.col("geo_provider")),
                "is_known_scanner_network": networks.is_known_scanner_network(org),
                "network_type": networks.network_type(org, F.col("geo_provider"), has_geo),
            }
        )
        .drop("_probe", "_geo_ip", *[f"_geo_{name}" for name in GEO_FIELDS])
    )


def compare_sources(records: DataFrame, second: DataFrame) -> DataFrame:
    """Distance and severity against a second source; its values never replace the first's."""
    side = second.select(
        join_key("ip").alias("_second_ip"),
        F.col("latitude").alias("_second_latitude"),
        F.col("longitude").alias("_second_longitude"),
        F.coalesce("country_code", F.lit("")).alias("_second_country"),
    )
    joined = records.withColumn("_probe", _probe(records)).join(side, F.col("_probe") == F.col("_second_ip"), "left")
    distance = networks.haversine_km(
        F.col("geo_latitude"), F.col("geo_longitude"), F.col("_second_latitude"), F.col("_second_longitude")
    )
    differs = F.coalesce(
        (F.col("geo_country_code") != "")
        & (F.col("_second_country") != "")
        & (F.col("geo_country_code") != F.col("_second_country")),
        F.lit(False),
    )
    return (
        joined.withColumn("geo_distance_km", distance)
        .withColumn("geo_divergence_severity", networks.divergence_severity(F.col("geo_distance_km"), differs))
        .withColumn("geo_sources_divergent", F.col("geo_divergence_severity") == "alta")
        .drop("_probe", "_second_ip", "_second_latitude", "_second_longitude", "_second_country")
    )


def geo_dimension(ips: DataFrame, geo: DataFrame, second: DataFrame) -> DataFrame:
    """The 16 geo and disagreement columns, once per distinct address."""
    return compare_sources(enrich_geo(ips.select("ip"), geo), second)


def attach_geo(records: DataFrame, dimension: DataFrame) -> DataFrame:
    """enrich_geo and compare_sources in a single join of the records.

    All 16 columns depend on the address alone, so they are computed per distinct
    address and the wide records are shuffled once.
    """
    fields = [field for field in dimension.schema.fields if field.name != "ip"]
    side = dimension.select(join_key("ip").alias("_geo_ip"), *[F.col(f.name).alias(f"_geo_{f.name}") for f in fields])
    joined = records.withColumn("_probe", _probe(records)).join(side, F.col("_probe") == F.col("_geo_ip"), "left")
    absent = {"string": F.lit(""), "boolean": F.lit(False)}

    def value(field: T.StructField) -> Column:
        found, default = F.col(f"_geo_{field.name}"), absent.get(field.dataType.simpleString())
        return found if default is None else F.coalesce(found, default)

    return joined.withColumns({f.name: value(f) for f in fields}).drop(
        "_probe", "_geo_ip", *[f"_geo_{f.name}" for f in fields]
    )


def second_source_records(responses: DataFrame) -> DataFrame:
    """Raw second-source rows (ip, country, city, region, postal, loc, timezone, org) -> geo records."""

    def text(name: str) -> Column:
        return F.coalesce(name, F.lit(""))

    location = text("loc")
    return responses.select(
        "ip",
        text("country").alias("country_code"),
        F.lit(None).cast("string").alias("country_name"),
        text("city").alias("city"),
        text("region").alias("region"),
        text("postal").alias("postal_code"),
        networks.location_part(location, 1).alias("latitude"),
        networks.location_part(location, 2).alias("longitude"),
        text("timezone").alias("timezone"),
        text("org").alias("org"),
    )
