"""Bronze lines, geo tables and caches derived from the events table (rules of FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtrail.operators.once import compute_once
from logtrail.schemas import GEO_RECORD_SCHEMA
from logtrail.sources.raw_events import Collection, bronze_rows, utc

LOG_GROUP = "/functions/control"
RUN = Collection(
    now=utc("2024-02-01T00:00:00"),
    window_start=utc("2024-01-01T00:00:00"),
    window_end=utc("2024-02-01T00:00:00"),
    log_group=LOG_GROUP,
)
SITE_HOST = "site.example"

# User agent by user_id mod 8.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0",
    "Mozilla/5.0 (iPhone) Safari/604.1",
    "curl/8.0",
    "WhatsApp/2.23",
    "Mozilla/5.0 Chrome/120.0 Edg/120.0",
    "zgrab/0.1",
    "ExampleBot/1.0",
    "",
]
# Owner of a network by x mod 6 (number, name); 4 has no row.
OWNERS = {
    0: (16509, "Amazon.com, Inc."),
    1: (28573, "Claro NXT Telecomunicacoes Ltda"),
    2: (398324, "Censys, Inc."),
    3: (None, "Unnumbered Org"),
    5: (14061, "DigitalOcean, LLC"),
}


def events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """With `spread`, few input files (one scan task each) still use all cores afterwards."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread and len(raw.inputFiles()) < cores:
        raw = raw.repartition(cores, "event_id")
    return raw.select(
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        F.col("event_type").alias("y"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        # Every third event lies at a whole second.
        F.when(F.col("event_id") % 3 == 0, F.unix_seconds(F.col("ts").cast("timestamp")) * 1000)
        .otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("ms"),
    )


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def ip_column() -> Column:
    u, k = F.col("u"), F.col("k")
    return (
        F.when(u % 5 == 0, F.concat(F.lit("2001:db8:65a0:"), (u % 97).cast("string"), F.lit("::"), k.cast("string")))
        .when((u % 5 == 4) & (k < 10), "not-an-ip")
        .otherwise(F.concat(F.lit("198.18."), (u % 200).cast("string"), F.lit("."), k.cast("string")))
    )


def _request_json(ip: Column) -> list[Column]:
    """The request in two pieces."""
    e, u, k, ms = (F.col(name) for name in "e u k ms".split())
    mod8 = u % 8

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def optional(condition: Column, text: str) -> Column:
        return F.when(condition, text).otherwise("")

    return [
        F.concat(
            F.lit('{"version":'), F.when(e % 13 == 6, "bad").otherwise('"2.0"'),
            F.lit(',"rawPath":'), F.when(k % 9 == 0, '"/.env"').otherwise('"/"'),
            F.lit(',"rawQueryString":"q=}{"'),
            F.lit(',"headers":{"cf-connecting-ip":'), quoted(ip),
            F.lit(',"cf-ipcountry":'), quoted(_pick(u % 3, ["BR", "US", "DE"])),
            F.lit(',"host":'), F.when(k % 20 == 0, '"other.example"').otherwise(f'"{SITE_HOST}"'),
            F.lit(',"user-agent":'), quoted(_pick(mod8, USER_AGENTS)),
        ),
        F.concat(
            optional(k % 2 == 0, ',"accept-language":"pt-BR"'),
            optional(mod8.isin(3, 6), ',"range":"bytes=0-1"'),
            optional(k % 3 == 0, ',"sec-fetch-user":"?1","sec-fetch-site":"none"'),
            F.lit(',"x-forwarded-for":"'), ip, optional(k % 6 == 0, ", 10.0.0.1"), F.lit('"}'),
            F.lit(',"requestContext":{"http":{"method":'), F.when(k % 25 == 0, '"POST"').otherwise('"GET"'),
            F.lit(',"sourceIp":"172.68.7.16"},"timeEpoch":'), ms.cast("string"), F.lit("}}"),
        ),
    ]


def _step_by_step(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns, each in a step of its own. In one step the generated code of all of them is one
    method, longer than the JVM compiles (8,000 bytes), and every row runs in its interpreter."""
    for name, value in columns.items():
        rows = rows.withColumn(name, value).transform(compute_once, [name])
    return rows


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event columns plus collection_id: one row per log line and copy."""
    e, u, y, k = (F.col(name) for name in "e u y k".split())
    error, click, view = y == "error", y == "click", y == "view"
    active = y.isin("purchase", "error") | (view & (k % 2 == 1))
    bucket = F.concat(F.lit('"site-'), F.floor(e / 40).cast("string"), F.lit('"'))
    reason = (
        F.when(view, _pick(k % 4, ["scanner_agent", "social_preview_bot", "missing_accept_header", "unmapped_reason"]))
        .when(k % 7 == 0, "missing_accept_language_allowed")
        .otherwise("all_checks_passed")
    )

    def boolean(condition: Column) -> Column:
        return F.when(condition, "true").otherwise("false")

    head, tail = _request_json(F.col("ip"))
    execution = F.concat(
        F.lit('{"event": "lambda_execution", "origem_eventbridge": '), boolean(error),
        F.lit(', "temp_item": '), boolean(click),
        F.lit(', "active_items": '), F.when(active, "1").otherwise("0"),
        F.lit(', "bucket": '), F.when(active, bucket).otherwise("null"), F.lit("}"),
    )
    decision = F.concat(
        F.lit('{"event": "access_decision", "trusted": '), boolean(~view),
        F.lit(', "reason": "'), reason,
        F.lit('", "user_agent": "'), F.lower(_pick(u % 8, USER_AGENTS)), F.lit('"}'),
    )
    outcome = F.concat(
        F.when(y == "signup", '{"event": "deploy_triggered"}')
        .when(y == "purchase", "Servindo site via proxy S3")
        .when(click, "placeholder row found")
        .when(view & (k % 2 == 0), '{"event": "access_rejected"}')
        .when(view, '{"event": "active_site_untrusted_access"}')
        .when(
            k >= 50,
            F.concat(
                F.lit('{"event": "destroy_triggered", "bucket": '), bucket,
                F.lit(', "last_accessed_at": "2024-01-01T00:00:00+00:00"'),
                F.lit(', "expiration_time": "2024-01-15T00:00:00+00:00"}'),
            ),
        )
        .otherwise("Check: time is left."),
        F.when(e % 11 == 7, " tail").otherwise(""),
    )
    # One execution in 31 has the request id of the next one, in a stream of its own;
    # one in 101 runs for hours, its END and the line behind it in other hours than its START.
    rid = F.when(e % 31 == 0, e + 1).otherwise(e).cast("string")
    pace = F.when(e % 101 == 0, 1_500_000).otherwise(e % 4 * 250)
    stream = (
        F.when(e % 101 == 0, F.concat(F.lit("stream-long-"), e.cast("string")))
        .when(e % 31 == 0, "stream-twin")
        .otherwise(F.concat(F.lit("stream-"), (u % 8).cast("string")))
    )
    request_id = F.concat(F.lit("req-"), rid)
    end_id = F.when(e % 17 == 0, F.concat(F.lit("req-x"), rid)).otherwise(request_id)
    texts = {
        "ip": ip_column(), "head": head, "tail": tail, "execution": execution, "decision": decision, "outcome": outcome,
        "stream": stream, "request_id": request_id, "end_id": end_id,
    }
    request, request_id, end_id = F.concat("head", "tail"), F.col("request_id"), F.col("end_id")
    lines = F.array(
        F.concat(F.lit("START RequestId: "), request_id, F.lit(" Version: $LATEST")),
        F.when(~error, "Evento recebido:"),
        F.when(~error, F.when(e % 13 == 5, request.substr(1, 60)).otherwise(request)),
        F.col("execution"),
        F.when(~error, F.col("decision")),
        F.col("outcome"),
        F.when(e % 10 != 3, F.concat(F.lit("END RequestId: "), end_id)),
        F.concat(F.lit("REPORT RequestId: "), request_id),
    )
    copies = F.when(e % 5 == 0, F.array(F.lit("collect-1"), F.lit("collect-2"))).otherwise(F.array(F.lit("collect-1")))
    return (
        _step_by_step(events(spark, sf_dir, spread=True), texts)
        .select("e", "ms", pace.alias("pace"), "stream", copies.alias("copies"), F.posexplode(lines).alias("ln", "message"))
        .where(F.col("message").isNotNull())
        .withColumn("at", F.col("ms") + F.col("ln") * F.col("pace"))
        .select(
            F.concat(F.lpad(F.col("e").cast("string"), 12, "0"), F.lit("-"), F.col("ln").cast("string")).alias("eventId"),
            F.col("at").alias("timestamp"),
            (F.col("at") + 1500).alias("ingestionTime"),
            F.col("stream").alias("logStreamName"),
            "message",
            F.explode("copies").alias("collection_id"),
        )
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(raw_lines(spark, sf_dir), RUN, collection_id=F.col("collection_id"))


def _latitude(x: Column) -> Column:
    return (x % 170 - 85).cast("double")


def _longitude(x: Column) -> Column:
    return ((x * 3) % 360 - 180).cast("double")


def _numbered(spark: SparkSession, sf_dir: str, modulus: int) -> DataFrame:
    return events(spark, sf_dir).select((F.col("u") % modulus).cast("int").alias("x")).distinct()


def city_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One network per site number seen in the events, and a wide one around the upper half."""
    x = F.col("x")

    def rows(numbers: DataFrame, network: Column) -> DataFrame:
        country = _pick(x % 3, ["BR", "US", "DE"])
        return numbers.where(x % 10 != 9).select(
            network.alias("network"),
            country.alias("country_code"),
            F.concat(F.lit("Country "), country).alias("country_name"),
            F.concat(F.lit("city-"), x.cast("string")).alias("city"),
            F.concat(F.lit("region-"), (x % 7).cast("string")).alias("region"),
            F.lpad(x.cast("string"), 5, "0").alias("postal_code"),
            _latitude(x).alias("latitude"),
            _longitude(x).alias("longitude"),
            F.lit("UTC").alias("timezone"),
        )

    v4 = rows(_numbered(spark, sf_dir, 200), F.concat(F.lit("198.18."), x.cast("string"), F.lit(".0/24")))
    v6 = rows(_numbered(spark, sf_dir, 97), F.concat(F.lit("2001:db8:65a0:"), x.cast("string"), F.lit("::/64")))
    wide = _numbered(spark, sf_dir, 1).select(
        F.lit("198.18.128.0/17").alias("network"),
        F.lit("FR").alias("country_code"),
        F.lit("Country FR").alias("country_name"),
        F.lit("wide").alias("city"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("string").alias("postal_code"),
        F.lit(46.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
        F.lit("UTC").alias("timezone"),
    )
    return v4.unionByName(v6).unionByName(wide)


def asn_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("x")
    number, name = F.lit(None).cast("int"), F.lit(None).cast("string")
    for rest, (owner_number, owner_name) in OWNERS.items():
        number = F.when(x % 6 == rest, F.lit(owner_number).cast("int")).otherwise(number)
        name = F.when(x % 6 == rest, owner_name).otherwise(name)
    return (
        _numbered(spark, sf_dir, 200)
        .where(x % 6 != 4)
        .select(
            F.concat(F.lit("198.18."), x.cast("string"), F.lit(".0/24")).alias("network"),
            number.alias("asn_number"),
            name.alias("asn_name"),
        )
    )


def geo_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses whose last part divides by 3 are cached; by 9: known to have no data."""
    empty = F.col("k") % 9 == 0
    values = {"country_code": "ZZ", "country_name": "Cached", "city": "cached", "region": "", "postal_code": "",
              "timezone": "UTC", "org": "AS64500 Cached Hosting on AWS"}
    ips = events(spark, sf_dir).where(F.col("k") % 3 == 0).select(ip_column().alias("ip"), "k").where("ip <> 'not-an-ip'")
    return ips.distinct().select(
        "ip",
        *[
            F.when(~empty, F.lit(values[field.name])).alias(field.name)
            if field.name in values
            else F.when(~empty, F.lit(10.0)).alias(field.name)
            for field in GEO_RECORD_SCHEMA.fields[1:]
        ],
    )


def second_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second geo source, one raw response per distinct address; latitude is shifted or missing."""
    u = F.col("u")
    x = F.when(u % 5 == 0, u % 97).otherwise(u % 200).cast("int")
    shift = F.when(F.col("x") % 4 == 1, 2).when(F.col("x") % 4 == 2, 10).otherwise(0)
    latitude = F.least(F.col("x") % 170 - 85 + shift, F.lit(90))
    longitude = (F.col("x") * 3) % 360 - 180
    return (
        events(spark, sf_dir)
        .select(ip_column().alias("ip"), x.alias("x"))
        .where("ip <> 'not-an-ip'")
        .distinct()
        .select(
            "ip",
            F.when(F.col("x") % 11 == 0, "AR").otherwise(_pick(F.col("x") % 3, ["BR", "US", "DE"])).alias("country"),
            F.concat(F.lit("city-"), F.col("x").cast("string")).alias("city"),
            F.lit("").alias("region"),
            F.lit("").alias("postal"),
            F.when(F.col("x") % 4 == 3, "unknown")
            .otherwise(F.concat(latitude.cast("string"), F.lit(","), longitude.cast("string")))
            .alias("loc"),
            F.lit("UTC").alias("timezone"),
            F.lit("").alias("org"),
        )
    )
