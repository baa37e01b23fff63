"""Version history, incremental loads and the visit stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import history as hist
from ledgerlark.operators import incremental as inc
from ledgerlark.operators.history_store import HistoryTable, Run
from ledgerlark.operators.keyed import KeyedTable
from ledgerlark.operators.restate import Load, RestatedTable
from ledgerlark.operators.staging import typed
from ledgerlark.registry.base import Tables, part, query
from ledgerlark.registry.marketing import visits
from ledgerlark.registry.revenue import hierarchy
from ledgerlark.session import scratch_path
from ledgerlark.sources.files import publish_view, write_table
from ledgerlark.sources.schemas import LOADED_AT
from ledgerlark.streaming import late
from ledgerlark.streaming import visits as stream

RUN_1 = "TIMESTAMP '2002-01-01 00:00:00'"
RUN_2 = "TIMESTAMP '2002-01-02 00:00:00'"


def price_history(t: Tables):
    first = hist.snapshot_by_check(None, t["raw_prices_first"], ["id"], ["price"], F.expr(RUN_1))
    return hist.snapshot_by_check(first, t["raw_prices_second"], ["id"], ["price"], F.expr(RUN_2))


def _scd(key: str, stamp: str) -> str:
    return f"md5({key} || '-' || strftime({stamp}, '%Y-%m-%d %H:%M:%S.%f'))"


@query(
    "scd2_check",
    f"""WITH pair AS (
          SELECT COALESCE(a.id, b.id) AS id, a.id AS old_id, b.id AS new_id, a.price AS old_price, b.price AS new_price
          FROM raw_prices_first a FULL OUTER JOIN raw_prices_second b ON a.id = b.id),
        versions AS (
          SELECT id, old_price AS price, {RUN_1} AS valid_from,
                 CASE WHEN new_id IS NULL OR new_price IS DISTINCT FROM old_price THEN {RUN_2} END AS valid_to
          FROM pair WHERE old_id IS NOT NULL
          UNION ALL
          SELECT id, new_price, {RUN_2}, NULL FROM pair
          WHERE new_id IS NOT NULL AND (old_id IS NULL OR new_price IS DISTINCT FROM old_price))
        SELECT id, CAST(price AS DOUBLE) AS price, {_scd("CAST(id AS VARCHAR)", "valid_from")} AS scd_id,
               valid_from AS updated_at, valid_from, valid_to FROM versions""",
)
def scd2_check(t: Tables):
    return price_history(t)


RATE_KEYS = ["date", "base_currency", "target_currency"]


def rate_snapshot(t: Tables, binding: str):
    return typed(t[binding], "exchange_rates").withColumnRenamed("rate", "exchange_rate")


def rate_history(t: Tables):
    first = hist.snapshot_by_timestamp(None, rate_snapshot(t, "raw_rates"), RATE_KEYS, "_loaded_at", F.expr(RUN_1))
    return hist.snapshot_by_timestamp(
        first, rate_snapshot(t, "raw_rates_second"), RATE_KEYS, "_loaded_at", F.expr(RUN_2)
    )


_RATE_PAIR = f"""pair AS (
      SELECT COALESCE(a.date, b.date) AS date, COALESCE(a.base_currency, b.base_currency) AS base_currency,
             COALESCE(a.target_currency, b.target_currency) AS target_currency, a.date AS old_date, b.date AS new_date,
             CAST(a.rate AS DECIMAL(10,4)) AS old_rate, CAST(b.rate AS DECIMAL(10,4)) AS new_rate,
             a._fivetran_synced AS old_at, b._fivetran_synced AS new_at
      FROM raw_rates a FULL OUTER JOIN raw_rates_second b
        ON a.date = b.date AND a.base_currency = b.base_currency AND a.target_currency = b.target_currency),
    versions AS (
      SELECT date, base_currency, target_currency, old_rate AS exchange_rate, old_at AS _loaded_at,
             old_at AS valid_from, CASE WHEN new_at > old_at THEN new_at WHEN new_date IS NULL THEN {RUN_2} END AS valid_to
      FROM pair WHERE old_date IS NOT NULL
      UNION ALL
      SELECT date, base_currency, target_currency, new_rate, new_at, new_at, NULL FROM pair
      WHERE new_date IS NOT NULL AND (old_date IS NULL OR new_at > old_at))"""


@query(
    "scd2_timestamp",
    f"""WITH {_RATE_PAIR}
        SELECT date, base_currency, target_currency, CAST(exchange_rate AS DOUBLE) AS exchange_rate, _loaded_at,
               {_scd("CAST(date AS VARCHAR) || '-' || base_currency || '-' || target_currency", "valid_from")} AS scd_id,
               valid_from AS updated_at, valid_from, valid_to FROM versions""",
)
def scd2_timestamp(t: Tables):
    return rate_history(t)


@query(
    "scd2_as_of",
    f"""WITH {_RATE_PAIR},
        facts AS (SELECT id, created_at AS date, 'GBP' AS base_currency, UPPER(currency) AS target_currency,
                         _fivetran_synced + INTERVAL '12' HOUR AS settled_at FROM raw_payments)
        SELECT f.id, f.date, f.base_currency, f.target_currency, f.settled_at,
               CAST(v.exchange_rate AS DOUBLE) AS exchange_rate
        FROM facts f LEFT JOIN versions v
          ON f.date = v.date AND f.base_currency = v.base_currency AND f.target_currency = v.target_currency
         AND f.settled_at >= v.valid_from AND (v.valid_to IS NULL OR f.settled_at < v.valid_to)""",
)
def scd2_as_of(t: Tables):
    facts = t["raw_payments"].select(
        "id",
        F.col("created_at").alias("date"),
        F.lit("GBP").alias("base_currency"),
        F.upper("currency").alias("target_currency"),
        (F.col(LOADED_AT) + F.expr("INTERVAL '12' HOUR")).alias("settled_at"),
    )
    return hist.as_of(facts, rate_history(t), RATE_KEYS, "settled_at", ["exchange_rate"])


@query(
    "visits_incremental",
    """SELECT * FROM raw_visits_second
       WHERE visited_at > (SELECT MAX(visited_at) FROM raw_visits_first)""",
)
def visits_incremental(t: Tables):
    """The second delivery, cut at the high-water mark of the first."""
    return inc.new_visits(t["raw_visits_second"], t["raw_visits_first"])


_LOOKUP = """
    SELECT v.id AS visit_id, v.visited_at, v.customer_id, NULLIF(v.gclid, '') AS gclid, v.landing_page,
           v.device_category, v._fivetran_synced AS _loaded_at, m.attributed_platform, m.attributed_campaign_id,
           m.attributed_campaign_name, m.attributed_ad_id, m.attributed_ad_name
    FROM {rows} v JOIN m_visits m ON v.id = m.visit_id"""


@query(
    "visits_upsert",
    f"""WITH b AS ({_LOOKUP.format(rows="raw_visits_second")}), a AS ({_LOOKUP.format(rows="raw_visits_first")})
        SELECT * FROM b UNION ALL SELECT * FROM a WHERE visit_id NOT IN (SELECT visit_id FROM b)""",
)
def visits_upsert(t: Tables):
    """Both deliveries merged on the visit id; corrections replace the earlier row."""
    return inc.upsert(
        visits(t, "raw_visits_first"), visits(t, "raw_visits_second"), ["visit_id"], [F.col("_loaded_at")]
    )


def _landed(t: Tables, *bindings: str) -> str:
    """Write deliveries as the loader would, one folder of files per delivery."""
    root = scratch_path(t.spark, "visit-landing")
    for binding in bindings:
        write_table(t[binding], f"{root}/{binding}")
    return f"{root}/*"


@query("visits_stream", "SELECT * FROM m_visits")
def visits_stream(t: Tables):
    """The visit fact built by the streaming job from landed files."""
    source = stream.visit_stream(t.spark, _landed(t, "raw_visits"))
    lookup = hierarchy(t)
    table = inc.UpsertTable(
        t.spark, scratch_path(t.spark, "fct-visits"), stream.visits_schema(lookup), ["visit_id"]
    )
    job = stream.load_visits(source, lookup, table, scratch_path(t.spark, "visits-progress"))
    job.awaitTermination()
    return table.read().drop("_loaded_at")


@query(
    "visits_stream_conflicts",
    """SELECT id, visited_at, customer_id, NULLIF(gclid, '') AS gclid, landing_page, device_category
       FROM raw_visits WHERE id % 17 <> 0
       UNION ALL SELECT NULL, visited_at, customer_id, NULLIF(gclid, ''), landing_page, device_category
       FROM raw_visits WHERE id % 500 = 0""",
)
def visits_stream_conflicts(t: Tables):
    """Streamed deliveries in which a later copy withdraws an earlier visit."""
    source = stream.visit_stream(t.spark, _landed(t, "raw_visits_redelivered"))
    path = scratch_path(t.spark, "visit-store")
    stream.land_raw(source, path, scratch_path(t.spark, "landing-progress")).awaitTermination()
    return typed(stream.conflict_free(t.spark, path), "prod_web_visits").drop("_loaded_at")


# Four runs over the catalogue: the third one sees what the second saw.
PRICE_RUNS = {
    "2002-01-01 00:00:00": "raw_prices_first",
    "2002-01-02 00:00:00": "raw_prices_second",
    "2002-01-03 00:00:00": "raw_prices_second",
    "2002-01-04 00:00:00": "raw_prices_third",
}

_RUNS = f"""
    runs AS (SELECT * FROM (VALUES {", ".join(f"({n}, TIMESTAMP '{at}')" for n, at in enumerate(PRICE_RUNS))}) AS r(n, run_at)),
    delivered AS ({" UNION ALL ".join(f"SELECT {n} AS n, id, price FROM {name}" for n, name in enumerate(PRICE_RUNS.values()))}),
    seen AS (
      SELECT i.id, r.n, r.run_at, d.price, d.id IS NOT NULL AS here
      FROM (SELECT DISTINCT id FROM delivered) i CROSS JOIN runs r LEFT JOIN delivered d ON d.id = i.id AND d.n = r.n),
    steps AS (
      SELECT *, LAG(here, 1, false) OVER w AS was, LAG(price) OVER w AS before FROM seen WINDOW w AS (PARTITION BY id ORDER BY n)),
    begun AS (SELECT * FROM steps WHERE here AND (NOT was OR price IS DISTINCT FROM before)),
    ended AS (SELECT * FROM steps WHERE was AND (NOT here OR price IS DISTINCT FROM before))"""


@part
def _price_runs(t: Tables) -> tuple[HistoryTable, list[Run]]:
    """Every run against what the one before has stored."""
    table = HistoryTable(t.spark, scratch_path(t.spark, "price-history"), t["raw_prices_first"].schema, ["id"], buckets=16)
    return table, [table.snapshot_by_check(t[name], ["price"], at) for at, name in PRICE_RUNS.items()]


@query(
    "scd2_stored",
    f"""WITH {_RUNS}
        SELECT b.id, CAST(b.price AS DOUBLE) AS price, {_scd("CAST(b.id AS VARCHAR)", "b.run_at")} AS scd_id,
               b.run_at AS updated_at, b.run_at AS valid_from, MIN(e.run_at) AS valid_to
        FROM begun b LEFT JOIN ended e ON e.id = b.id AND e.n > b.n GROUP BY ALL""",
)
def scd2_stored(t: Tables):
    """History kept in a table over four runs; closed versions are written once."""
    return _price_runs(t)[0].read()


@query(
    "scd2_runs",
    f"""WITH {_RUNS}
        SELECT run_at, (SELECT COUNT(*) FROM begun b WHERE b.n = r.n) AS opened,
               (SELECT COUNT(*) FROM ended e WHERE e.n = r.n) AS closed FROM runs r""",
)
def scd2_runs(t: Tables):
    """What each run opened and closed: the repeated third one nothing."""
    told = [(at, run.opened, run.closed) for at, run in zip(PRICE_RUNS, _price_runs(t)[1], strict=True)]
    return t.spark.createDataFrame(told, "run_at string, opened bigint, closed bigint").withColumn("run_at", F.col("run_at").cast("timestamp"))


@query(
    "visits_merge",
    """SELECT id, visited_at, customer_id, NULLIF(gclid, '') AS gclid,
              CASE WHEN id % 11 = 0 THEN '/third'
                   WHEN id % 7 = 0 AND visited_at < TIMESTAMP '2024-01-16 00:00:00' THEN '/corrected'
                   ELSE landing_page END AS landing_page, device_category
       FROM raw_visits
       UNION ALL
       SELECT id, visited_at, customer_id, NULLIF(gclid, ''), landing_page, device_category
       FROM raw_visits_third WHERE id IS NULL""",
)
def visits_merge(t: Tables):
    """Three deliveries merged on the visit id, one of them sent twice, with a compaction in between."""
    deliveries = [typed(t[f"raw_visits_{name}"], "prod_web_visits") for name in ("first", "second", "third")]
    table = KeyedTable(t.spark, scratch_path(t.spark, "visits-merged"), deliveries[0].schema, ["id"], buckets=16)
    newest = [F.col("_loaded_at")]
    table.write_batch(deliveries[0], 0, newest)
    table.write_batch(deliveries[1], 1, newest)
    table.compact()
    table.write_batch(deliveries[2], 2, newest)
    table.write_batch(deliveries[1], 1, newest)  # a retry: it is there already
    return table.read().drop("_loaded_at")


@part
def _on_time(t: Tables):
    """Three deliveries through the stream, each landed when the one before has been loaded."""
    spark, raw = t.spark, stream.RAW_TABLES[stream.VISITS].schema
    source, beside, progress = (scratch_path(spark, n) for n in ("visits-landing", "visits-late", "visits-progress"))
    table = KeyedTable(spark, scratch_path(spark, "visits-on-time"), raw, ["id"], buckets=16)
    for name in ("early", "middle", "end"):
        t[f"raw_visits_{name}"].write.mode("append").parquet(source)
        late.load_on_time(stream.visit_stream(spark, source), table, beside, progress, "2 days").awaitTermination()
    return table.read(), late.late_rows(raw, table, beside)


_VISIT = "id, visited_at, customer_id, gclid, landing_page, device_category"


@query(
    "visits_on_time",
    f"""SELECT {_VISIT} FROM raw_visits WHERE NOT (id % 19 = 0 AND visited_at < TIMESTAMP '2024-01-05 00:00:00')
        UNION ALL SELECT {_VISIT} FROM raw_visits_middle WHERE visited_at IS NULL
        UNION ALL SELECT {_VISIT} FROM raw_visits_end WHERE id IS NULL""",
)
def visits_on_time(t: Tables):
    """The visits that came within two days of the newest one, each once, and those without a time or an id."""
    return _on_time(t)[0].drop(LOADED_AT)


@query("visits_late", f"SELECT {_VISIT} FROM raw_visits WHERE id % 19 = 0 AND visited_at < TIMESTAMP '2024-01-05 00:00:00'")
def visits_late(t: Tables):
    """The visits that came too late; repeats of loaded visits are not among them, however late they are."""
    return _on_time(t)[1].drop(LOADED_AT)


_CLICK_DAYS = "CAST(CAST(date AS DATE) AS VARCHAR) AS day"


@part
def _restated(t: Tables) -> tuple[RestatedTable, list[Load]]:
    first = t["raw_gads_clicks"]
    table = RestatedTable(t.spark, scratch_path(t.spark, "clicks"), first.schema, "date")
    return table, [table.load(t[name]) for name in ("raw_gads_clicks", "raw_gads_clicks_restated", "raw_gads_clicks_restated")]


@query(
    "restated_clicks",
    """SELECT ad_id, date, CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,
              CAST(cost AS DOUBLE) AS cost, CAST(conversions AS BIGINT) AS conversions FROM raw_gads_clicks_restated""",
)
def restated_clicks(t: Tables):
    """Ad results after a delivery that restates some days, of which alone the files are written."""
    return _restated(t)[0].read()


@query(
    "restated_days",
    f"""SELECT DISTINCT 0 AS delivery, {_CLICK_DAYS}, 'restated' AS what FROM raw_gads_clicks
        UNION ALL SELECT DISTINCT 1, {_CLICK_DAYS}, 'restated' FROM raw_gads_clicks_restated WHERE EXTRACT(DAY FROM date) % 5 = 0
        UNION ALL SELECT DISTINCT 1, {_CLICK_DAYS}, 'gone' FROM raw_gads_clicks WHERE EXTRACT(DAY FROM date) = 13""",
)
def restated_days(t: Tables):
    """The days that each of three deliveries wrote or took out; the third one, a repeat, none."""
    loads = _restated(t)[1]
    told = [(n, day, "restated") for n, load in enumerate(loads) for day in load.restated]
    told += [(n, day, "gone") for n, load in enumerate(loads) for day in load.gone]
    return t.spark.createDataFrame(told, "delivery int, day string, what string")


@query("view_sink", "SELECT id, name, status FROM raw_src_gads_campaigns")
def view_sink(t: Tables):
    """A staging view that is published by name and read by SQL."""
    publish_view(typed(t["raw_src_gads_campaigns"], "google_ads_campaigns"), "stg_google_ads_campaigns")
    return t.spark.sql("SELECT id, name, status FROM stg_google_ads_campaigns")
