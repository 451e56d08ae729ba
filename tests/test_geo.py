from __future__ import annotations

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from logtrail.functions import networks
from logtrail.operators import geo
from logtrail.schemas import GEO_COLUMNS, GEO_RECORD_SCHEMA
from logtrail.sources.geo_tables import ASN_BLOCK_SCHEMA, CITY_BLOCK_SCHEMA


def city_rows(spark, nets):
    rows = [(n, "BR", None, f"city {n}", "", None, 1.0, 2.0, "UTC") for n in nets]
    return spark.createDataFrame(rows, CITY_BLOCK_SCHEMA)


def test_longest_prefix_equals_brute_force(spark):
    rng = random.Random(4)
    nets = set()
    for _ in range(300):
        n = rng.choice([8, 12, 15, 17, 22, 24, 31, 32])
        nets.add(str(ipaddress.ip_network((rng.choice([0x0A000000, 0xA3740000]) | rng.getrandbits(20), n), strict=False)))
    for _ in range(200):
        n = rng.choice([19, 32, 47, 64, 127, 128])
        nets.add(str(ipaddress.ip_network(((0x20010DB8 << 96) | rng.getrandbits(90), n), strict=False)))
    ips = {str(ipaddress.ip_address(rng.choice([0x0A000000, 0xA3740000, 0x01000000]) | rng.getrandbits(20))) for _ in range(1500)}
    ips |= {str(ipaddress.ip_address((0x20010DB8 << 96) | rng.getrandbits(92))) for _ in range(500)}
    ips |= {"not-an-ip", "::ffff:10.0.0.7", "::1"}
    parsed = [ipaddress.ip_network(n) for n in nets]

    def best(ip):
        try:
            address = ipaddress.ip_address(ip)
        except ValueError:
            return None
        address = getattr(address, "ipv4_mapped", None) or address
        hits = [n for n in parsed if n.version == address.version and address in n]
        return str(max(hits, key=lambda n: n.prefixlen)) if hits else None

    asn = spark.createDataFrame([("10.0.0.0/8", 7, "Ten Net"), ("198.18.0.0/16", None, "Other")], ASN_BLOCK_SCHEMA)
    frame = spark.createDataFrame([(i,) for i in ips], "ip string")
    rows = geo.lookup_networks(frame, city_rows(spark, nets), asn).collect()
    assert len(rows) == len(ips)
    for row in rows:
        hit = best(row.ip)
        assert row.city == (f"city {hit}" if hit else None), row.ip
        assert row.country_name == ("" if hit else None)
        assert row.org == ("AS7 Ten Net" if row.ip.startswith("10.") or row.ip == "::ffff:10.0.0.7"
                           else "Other" if row.ip.startswith("198.18.") else None)


def test_owner_and_network_rules(spark):
    org = F.col("org")
    rows = {
        "AS28573 Claro NXT": ("AS28573", "Claro NXT", False, False, "residencial"),
        "AS16509 Amazon.com, Inc.": ("AS16509", "Amazon.com, Inc.", True, False, "cloud"),
        "AS398324 Censys, Inc.": ("AS398324", "Censys, Inc.", False, True, "scanner"),
        "Unnumbered Org": ("", "Unnumbered Org", False, False, "residencial"),
        "AS12": ("AS12", "", False, False, "residencial"),
        "ASxy Azure Rapid7": ("", "ASxy Azure Rapid7", True, True, "scanner"),
        "": ("", "", False, False, "residencial"),
    }
    df = spark.createDataFrame([(k,) for k in rows], "org string")
    for row in df.select(org, networks.org_asn(org), networks.org_provider(org),
                         networks.is_cloud_provider(networks.org_provider(org)), networks.is_known_scanner_network(org),
                         networks.network_type(org, networks.org_provider(org), F.lit(True))).collect():
        assert tuple(row[1:]) == rows[row.org], row.org
    values = spark.range(1).select(
        networks.asn_org(F.lit(5), F.lit("X")), networks.asn_org(F.lit(0), F.lit("X")),
        networks.asn_org(F.lit(None).cast("int"), F.lit(None).cast("string")), networks.asn_org(F.lit(5), F.lit("")),
        networks.location_part(F.lit("1.5,-2"), 1), networks.location_part(F.lit("1.5,-2"), 2),
        networks.location_part(F.lit("1.5"), 1), networks.location_part(F.lit("1,2,3"), 1),
        networks.network_type(F.lit("shodan"), F.lit("aws"), F.lit(False)),
    ).first()
    assert tuple(values) == ("AS5 X", "X", "", "AS5", 1.5, -2.0, None, None, "")


def test_severity_and_distance(spark):
    cases = {(50.0, False): "baixa", (100.0, False): "baixa", (100.1, False): "media", (500.0, False): "media",
             (500.1, False): "alta", (1.0, True): "alta", (None, True): "alta", (None, False): ""}
    df = spark.createDataFrame([(d, c, s) for (d, c), s in cases.items()], "d double, c boolean, s string")
    for row in df.select("s", networks.divergence_severity(F.col("d"), F.col("c"))).collect():
        assert row[1] == row.s
    lit = [F.lit(x) for x in (-23.55, -46.63, -22.91, -43.17)]
    (found,) = spark.range(1).select(networks.haversine_km(*lit)).first()
    assert found == pytest.approx(360.75, abs=0.5)
    (opposite,) = spark.range(1).select(networks.haversine_km(*[F.lit(x) for x in (0.0, 0.0, 0.0, 180.0)])).first()
    assert opposite == pytest.approx(6371.0 * 3.14159265, rel=1e-6)


def test_cache_enrich_and_compare(spark):
    records = spark.createDataFrame(
        [("r1", "10.0.0.1"), ("r2", "10.0.0.1"), ("r3", "1.1.1.1"), ("r4", ""), ("r5", None), ("r6", "2.2.2.2")],
        "request_id string, ip string",
    )
    cache = spark.createDataFrame(
        [("1.1.1.1",) + (None,) * 9, ("9.9.9.9", "US", "", "", "", "", 0.0, 0.0, "", "AS1 AWS")], GEO_RECORD_SCHEMA)
    ips = geo.distinct_ips(records)
    asn = spark.createDataFrame([("10.0.0.0/8", 16509, "Amazon")], ASN_BLOCK_SCHEMA)
    assert {r.ip for r in geo.uncached_ips(ips, cache).collect()} == {"10.0.0.1", "2.2.2.2"}
    table = geo.extend_cache(ips, cache, city_rows(spark, ["10.0.0.0/24", "1.1.1.0/24"]), asn)
    assert {r.ip for r in table.collect()} == {"10.0.0.1", "2.2.2.2", "1.1.1.1", "9.9.9.9"}
    rich = geo.enrich_geo(records, table)
    assert set(rich.columns) == {"request_id", "ip", *GEO_COLUMNS}
    second = spark.createDataFrame([("10.0.0.1", "AR", 1.0, 2.0), ("1.1.1.1", "US", None, None)],
                                   "ip string, country_code string, latitude double, longitude double")
    compared = geo.compare_sources(rich, second)
    rows = {r.request_id: r for r in compared.collect()}
    once = geo.attach_geo(records, geo.geo_dimension(ips, table, second))
    assert {r.request_id: r.asDict() for r in once.collect()} == {k: r.asDict() for k, r in rows.items()}
    assert len(rows) == 6
    assert (rows["r1"].geo_asn, rows["r1"].network_type, rows["r1"].geo_country_code) == ("AS16509", "cloud", "BR")
    assert (rows["r1"].geo_distance_km, rows["r1"].geo_divergence_severity) == (0.0, "alta")
    for rid in ("r3", "r4", "r5", "r6"):
        assert (rows[rid].network_type, rows[rid].geo_city, rows[rid].geo_latitude) == ("", "", None)
        assert (rows[rid].geo_distance_km, rows[rid].geo_sources_divergent) == (None, False)
