"""Queries: scans, tables on disk, layouts and table upkeep."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tiffin.catalog.models import fct_orders
from tiffin.catalog.oracle import draw
from tiffin.catalog.registry import query
from tiffin.catalog.relational import order_facts
from tiffin.catalog.scalars import KEYWORD_SQL, hits_sql
from tiffin.functions import text
from tiffin.functions.draws import md5_draw
from tiffin.operators import history, layout
from tiffin.plans import finance, marts, reviews
from tiffin.session import scratch
from tiffin.sources import landing, tables
from tiffin.sources.bronze import Bronze


@query("s01_scan_columns", "select o_orderkey, o_custkey, o_orderstatus from orders")
def s01(b: Bronze):
    return b.raw("orders", "o_orderkey", "o_custkey", "o_orderstatus")


@query("s02_typed_table", "select order_id, line_no, quantity, unit_price, line_total from b_lines")
def s02(b: Bronze):
    return b.lines().select("order_id", "line_no", "quantity", "unit_price", "line_total")


@query("s03_overwrite_readback", "select * from m_fct_orders")
def s03(b: Bronze):
    path = scratch(b.spark, "fct_orders")
    mart = fct_orders(b)
    for _ in range(2):  # a full overwrite may be repeated
        tables.overwrite(mart, marts.CONTRACTS["fct_orders"], path, "fct_orders")
    return b.spark.read.schema(mart.schema).parquet(path)


def _daily(b: Bronze):
    return b.order_heads().select("order_id", "customer_id", F.to_date("placed_at").alias("day"),
                                  F.lit(1).alias("revision"))


@query("s04_slice_replace", """select order_id, customer_id, cast(placed_at as date) as day,
 case when cast(placed_at as date) >= date '1997-01-01' and cast(placed_at as date)
  < date '1997-07-01' then 2 else 1 end as revision from b_heads
where not (cast(placed_at as date) >= date '1997-03-01' and cast(placed_at as date)
 < date '1997-04-01')""")
def s04(b: Bronze):
    """Half a year written again with one month now empty; everything else is untouched."""
    rows = _daily(b)
    table = tables.VersionedTable(b.spark, scratch(b.spark, "slices"), rows.schema,
                                  F.date_format("day", "yyyy-MM"))
    table.replace(rows)
    again = rows.filter("day >= date'1997-01-01' and day < date'1997-07-01' and not "
                        "(day >= date'1997-03-01' and day < date'1997-04-01')") \
        .withColumn("revision", F.lit(2))
    table.replace(again, (F.col("_part") >= "1997-01") & (F.col("_part") < "1997-07"))
    return table.read()


@query("s05_chunked_backfill", """select order_id + cast(floor((cast(placed_at as date)
 - (select min(cast(o_orderdate as date)) from orders)) / 365.0) as bigint) * 1000000000 as order_id,
 cast(placed_at as date) as day from b_heads""")
def s05(b: Bronze):
    """A backfill in yearly chunks, ids shifted into one block per chunk, one chunk run twice."""
    bounds = b.raw("orders").agg(F.to_date(F.min("o_orderdate")).alias("d0"),
                                 F.to_date(F.max("o_orderdate")).alias("d1"))
    block = 1_000_000_000
    top = b.raw("orders").agg(F.max("o_orderkey")).first()[0]
    tables.check_capacity(top, 1, block)
    plan = tables.chunks(bounds, "d0", "d1", 365)
    first = bounds.select("d0").scalar()
    days = _daily(b).select("order_id", "day")
    shifted = days.withColumn("order_id", F.col("order_id") + F.floor(
        F.datediff("day", first) / 365).cast("bigint") * block)
    path = scratch(b.spark, "backfill")
    tables.backfill(shifted, "day", plan, path)
    tables.backfill(shifted, "day", plan.filter("chunk = 1"), path)
    return b.spark.read.parquet(path).select("order_id", "day")


@query("s06_csv_landing", """select cast(order_id as varchar) as order_id, delivery_notes,
 cast(null as varchar) as _bronze_rescued from b_heads""")
def s06(b: Bronze):
    """Most notes are NULL and come back as such."""
    path = scratch(b.spark, "csv")
    notes = b.order_heads().select("order_id", "delivery_notes")
    landing.export(notes, path)
    return landing.read_csv(b.spark, path, ["order_id", "delivery_notes"])


@query("s06_text_landing", """select cast(doc_id as varchar) as doc_id, text,
 cast(null as varchar) as _bronze_rescued from documents""")
def s06_text(b: Bronze):
    """Texts with line breaks and quotes come back as they were."""
    path = scratch(b.spark, "csv")
    landing.export(b.raw("documents", "doc_id", "text"), path)
    return landing.read_csv(b.spark, path, ["doc_id", "text"])


@query("s07_ingest_metadata", """select c_custkey as customer_id, 'batch-1' as _bronze_batch_id,
 true as has_file, true as has_time from customer""")
def s07(b: Bronze):
    df = landing.with_metadata(b.raw("customer"), "batch-1")
    return df.select(F.col("c_custkey").alias("customer_id"), "_bronze_batch_id",
                     F.col("_bronze_source_file").endswith("parquet").alias("has_file"),
                     F.col("_bronze_ingested_at").isNotNull().alias("has_time"))


@query("s09_landing_shards", f"""select cast({draw(1, 'event_id')} % 4 as bigint) as shard,
 count(*) as n, cast(sum(event_id) as bigint) as id_sum from b_events group by 1""")
def s09(b: Bronze):
    """All shards written as JSON and read back."""
    root = scratch(b.spark, "shards")
    landing.write_shards(b.order_events().select("event_id"), md5_draw(1, "event_id") % 4, root)
    back = b.spark.read.schema("event_id string").json(root).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"shard=(\d+)", 1).cast("bigint")
        .alias("shard"), F.col("event_id").cast("bigint").alias("id"))
    return back.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query("s10_defect_export", """select cast(refund_id as varchar) as refund_id, refund_amount_raw,
 '  ' || reason || ' ' as reason from b_refunds""")
def s10(b: Bronze):
    """Text money and untrimmed text survive a compressed export."""
    path = scratch(b.spark, "export")
    rows = b.refunds().select("refund_id", "refund_amount_raw",
                              F.concat(F.lit("  "), "reason", F.lit(" ")).alias("reason"))
    landing.export(rows, path, "csv", gzip=True)
    return landing.read_csv(b.spark, path, rows.columns).drop(landing.RESCUED)


@query("s11_freshness", """select m as max_loaded_at, a as age_seconds, case when a > 86400 then 'error'
 when a > 21600 then 'warn' else 'pass' end as status from (select max(received_at) as m,
 epoch_us(timestamp '2024-02-03 00:00:00') // 1000000 - epoch_us(max(received_at)) // 1000000 as a
 from b_events)""")
def s11(b: Bronze):
    return tables.freshness(b.order_events(), "received_at",
                            F.lit("2024-02-03 00:00:00").cast("timestamp"))


@query("s12_table_statistics")
def s12(b: Bronze):
    """Files, bytes and rows. The first two are facts of the storage, which SQL does not see; tests
    hold them against the file system."""
    return tables.file_stats(b.raw("lineitem"))


# -- upserts ---------------------------------------------------------------------------------


@query("m01_upsert", """select order_id, customer_id, cast(placed_at as date) as day,
 case when cast(placed_at as date) >= date '1999-01-01' then 2 else 1 end as revision from b_heads""")
def m01(b: Bronze):
    """A first load without the last year, then a batch that updates 1999 on and adds the rest."""
    rows = _daily(b)
    table = tables.VersionedTable(b.spark, scratch(b.spark, "upsert"), rows.schema,
                                  F.date_format("day", "yyyy"))
    table.upsert(rows.filter("day < date'2000-06-01'"), ["order_id"])
    batch = rows.filter("day >= date'1999-01-01'").withColumn("revision", F.lit(2))
    for _ in range(2):
        table.upsert(batch, ["order_id"])
    return table.read()


@query("m02_keyed_append", """select order_id, cast(case when cast(placed_at as date)
 < date '1998-01-01' then 1 else 2 end as integer) as app_version from b_heads""")
def m02(b: Bronze):
    """Two appends, the second one delivered twice."""
    path = scratch(b.spark, "append")
    rows = _daily(b).select("order_id", "day")
    tables.append_keyed(rows.filter("day < date'1998-01-01'").select("order_id"), path, "load", 1)
    for _ in range(2):
        tables.append_keyed(rows.filter("day >= date'1998-01-01'").select("order_id"), path,
                            "load", 2)
    return b.spark.read.parquet(path).select("order_id", F.col("app_version").cast("int"))


@query("t13_event_clock_lookback", """select event_id, order_id, occurred_at from b_events""")
def t13(b: Bronze):
    """Two incremental runs by the event clock: the second one re-reads the last three days."""
    events = b.order_events().select("event_id", "order_id", "occurred_at")
    table = tables.VersionedTable(b.spark, scratch(b.spark, "lookback"), events.schema,
                                  F.to_date("occurred_at"))
    table.upsert(events.filter("occurred_at < timestamp'2024-01-20 00:00:00'"), ["event_id"])
    table.upsert(history.recent(events, "occurred_at", table.read(), 3), ["event_id"])
    return table.read()


@query("m15_corrected_backfill", """
select payout_cycle_id, count(*) as n, cast(sum(fee) as bigint) as fee_cents,
 cast(sum(fee - platform_fee_cents) as bigint) as adjustment_cents
from (select f.order_id, platform_fee_cents, cast(floor((order_date - date '1995-01-02') / 7.0) + 1
  as integer) as payout_cycle_id, case when precedence = 3 and order_date >= date '2001-07-25'
  then 120 else platform_fee_cents end as fee from m_fee f) group by 1""")
def m15(b: Bronze):
    """A correction arrives as a new effective row; only cycles from its date on change."""
    from tiffin.functions.clock import payout_cycle
    facts = order_facts(b).select("order_id", "order_date", "restaurant_id", "city_id")
    card = b.fee_schedule()
    late = F.lit("2001-07-25").cast("date")
    open_global = (F.col("scope") == "GLOBAL") & F.col("effective_to").isNull()
    closed = card.withColumn("effective_to", F.when(open_global, late)
                             .otherwise(F.col("effective_to")))
    correction = card.filter(open_global).withColumn("effective_from", late).withColumn(
        "platform_fee_cents", F.lit(120).cast("bigint"))
    before = finance.fee_asof(facts, card).select(
        "order_id", "order_date", F.col("platform_fee_cents").alias("old"))
    after = finance.fee_asof(facts, closed.unionByName(correction)).select(
        "order_id", F.col("platform_fee_cents").alias("new"))
    cycle = payout_cycle(F.col("order_date"), "1995-01-02")
    return before.join(after, "order_id").groupBy(cycle.alias("payout_cycle_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("new").alias("fee_cents"),
        F.sum(F.col("new") - F.col("old")).alias("adjustment_cents"))


# -- layouts ---------------------------------------------------------------------------------

FILES = 16


def _bench(b: Bronze):
    return b.orders().select("order_id", "zone_id", "order_status", "order_total",
                             F.to_date("placed_at").alias("date_day"))


@query("m06_compaction", """select state, n_files, (select count(*) from b_orders) as n_rows
from (values ('before', cast(16 as bigint)), ('after', cast(2 as bigint))) as f(state, n_files)""")
def m06(b: Bronze):
    """Rewrites to a target file count; the rows stay."""
    path, small = scratch(b.spark, "many"), scratch(b.spark, "few")
    layout.compacted(_bench(b), path, FILES)
    layout.compacted(b.spark.read.parquet(path), small, 2)
    before = tables.file_stats(b.spark.read.parquet(path)).withColumn("state", F.lit("before"))
    after = tables.file_stats(b.spark.read.parquet(small)).withColumn("state", F.lit("after"))
    return before.unionByName(after).select("state", "n_files", "n_rows")


WINDOW_START, WINDOW_DAYS = "1996-06-01", 10  # the benchmark's table covers ten days


def _layouts(b: Bronze):
    """The orders in four layouts, their days folded into a window as long as the published one, so
    that a day's folder holds a tenth of the table."""
    folded = F.pmod(F.datediff("date_day", F.lit("1992-01-01").cast("date")), F.lit(WINDOW_DAYS))
    rows = _bench(b).withColumn("date_day", F.date_add(F.lit(WINDOW_START).cast("date"), folded))
    paths = {name: scratch(b.spark, name) for name in layout.LAYOUTS}
    for name, path in paths.items():
        layout.LAYOUTS[name](rows, path, FILES)
    return paths


@query("m10_layout_parity", """select l.layout, (select count(*) from b_orders) as n_rows,
 (select cast(sum(order_total) as decimal(28,2)) from b_orders) as revenue
from (values ('clustered'), ('compacted'), ('partitioned'), ('z_ordered')) as l(layout)
where (select count(*) from orders) > 0""")
def m10(b: Bronze):
    """M07 to M10: four layouts of one table hold the same rows."""
    out = None
    for name, path in _layouts(b).items():
        row = b.spark.read.parquet(path).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("order_total").cast("decimal(28,2)").alias("revenue")).select(
            F.lit(name).alias("layout"), "n_rows", "revenue")
        out = row if out is None else out.unionByName(row)
    return out


def _rewritten(b: Bronze, write, *args):
    path = scratch(b.spark, "layout")
    write(_bench(b).select("order_id", "zone_id", "order_total", "date_day"), path, *args)
    return b.spark.read.parquet(path).select("order_id", "zone_id", "order_total", "date_day")


_SAME = "select order_id, zone_id, order_total, cast(placed_at as date) as date_day from b_orders"


@query("m07_partitioned_layout", _SAME)
def m07(b: Bronze):
    """A folder per day."""
    return _rewritten(b, layout.partitioned, "date_day")


@query("m08_z_ordered_layout", _SAME)
def m08(b: Bronze):
    """Two columns on one curve."""
    return _rewritten(b, layout.z_ordered, ["zone_id", "order_id"], FILES)


@query("m09_clustered_layout", _SAME)
def m09(b: Bronze):
    return _rewritten(b, layout.clustered, ["zone_id"], FILES)


def layout_results(b: Bronze, paths: dict[str, str] | None = None):
    """Milliseconds and bytes read by the four fixed queries in each layout."""
    return layout.measured(b.spark, paths or _layouts(b))


@query("m13_layout_benchmark")
def m13(b: Bronze):
    """The bytes of each layout by the tasks' own count, and which layout wins; layouts that do not
    agree on a result make it fail. Bytes are facts of the storage, so there is no SQL."""
    found = layout_results(b)
    wrong = [r[0] for r in layout.disparity(found).collect()]
    if wrong:
        raise ValueError(f"layouts differ in {wrong}")
    return found.select("layout", "query_name", "bytes_scanned").withColumn(
        "wins", F.col("layout") == layout.winner(found).select("layout").scalar())


_LAYOUT_SQL = {
    "date_range": f"where (cast(placed_at as date) - date '1992-01-01') % {WINDOW_DAYS} "
                  "between 2 and 5",  # the window's third to sixth day
    "zone": "where zone_id = 1", "status": "where order_status = 'DELIVERED'"}


@query("m13_layout_results", "select * from (values ('clustered'), ('compacted'), ('partitioned'), "
       "('z_ordered')) as l(layout), (" + " union all ".join(
           f"select '{q}' as query_name, count(*) as n_orders, cast(sum(order_total) as "
           f"decimal(28,2)) as revenue from b_orders {w}" for q, w in _LAYOUT_SQL.items()) + ")")
def m13_results(b: Bronze):
    """The totals that the benchmark's filters give in each layout."""
    out = None
    for name, path in _layouts(b).items():
        for key in _LAYOUT_SQL:
            rows = b.spark.sql(layout.QUERIES[key], t=b.spark.read.parquet(path)) \
                .toDF("n_orders", "revenue")
            rows = rows.select(F.lit(name).alias("layout"), F.lit(key).alias("query_name"),
                               "n_orders", F.col("revenue").cast("decimal(28,2)"))
            out = rows if out is None else out.unionByName(rows)
    return out


@query("m11_column_statistics", """
select 'c_nationkey' as col_name, 'min' as info_name, cast(min(c_nationkey) as varchar) as info_value
 from customer
union all select 'c_nationkey', 'max', cast(max(c_nationkey) as varchar) from customer
union all select 'c_nationkey', 'num_nulls', cast(count(*) - count(c_nationkey) as varchar)
 from customer""")
def m11(b: Bronze):
    """Statistics of a table as the catalogue reports them after ANALYZE."""
    name = f"tiffin_stats_{uuid.uuid4().hex}"
    b.raw("customer").write.option("path", scratch(b.spark, "stats")).saveAsTable(name)
    try:
        layout.column_statistics(b.spark, name)
        rows = b.spark.sql(f"describe extended {name} c_nationkey")  # runs at once
    finally:
        b.spark.sql(f"drop table {name}")
    return rows.filter(F.col("info_name").isin("min", "max", "num_nulls")).select(
        F.lit("c_nationkey").alias("col_name"), "info_name", "info_value")


@query("m12_corpus_fan_out", """select ping_id + copy * 1000000000 as ping_id,
 courier_id + copy * 100000 as courier_id, order_id + copy * 10000000 as order_id,
 ping_ts + to_days(cast(copy as integer)) as ping_ts, accuracy_m
from b_pings, (select unnest(generate_series(0, 4)) as copy)""")
def m12(b: Bronze):
    pings = b.gps_pings().select("ping_id", "courier_id", "order_id", "ping_ts", "accuracy_m")
    return layout.fanned_out(pings, 5, {"ping_id": 1_000_000_000, "courier_id": 100_000,
                                        "order_id": 10_000_000}, "ping_ts")


_LAB = {
    "point_lookup": ("select count(*) as n, max(ping_ts) as latest from {p} where courier_id = 7",
                     "select count(*) as n, max(ping_ts) as latest from b_pings where courier_id = 7"),
    "range_scan": ("select count(*) as n from {p} where cast(ping_ts as date) between "
                   "date'2024-01-10' and date'2024-01-12'",
                   "select count(*) as n from b_pings where cast(ping_ts as date) between "
                   "date '2024-01-10' and date '2024-01-12'"),
    "join_heavy": ("select o.zone_id, count(*) as pings, count(distinct p.courier_id) as couriers "
                   "from {p} p join {o} o on p.order_id = o.order_id "
                   "where o.placed_at >= timestamp'1996-01-01' group by o.zone_id",
                   "select o.zone_id, count(*) as pings, count(distinct p.courier_id) as couriers "
                   "from b_pings p join b_shells o on p.order_id = o.order_id "
                   "where o.placed_at >= timestamp '1996-01-01' group by o.zone_id"),
    "aggregation": ("select cast(ping_ts as date) as ping_date, count(*) as n, "
                    "round(avg(accuracy_m), 6) as avg_acc from {p} group by 1",
                    "select cast(ping_ts as date) as ping_date, count(*) as n, "
                    "round(avg(accuracy_m), 6) as avg_acc from b_pings group by 1"),
    "high_card_filter": ("select count(*) as n from {p} where courier_id = 7 and accuracy_m < 25",
                         "select count(*) as n from b_pings where courier_id = 7 "
                         "and accuracy_m < 25"),
}


def _register_lab(name: str, sql: str, oracle: str) -> None:
    @query(f"m14_{name}", oracle)
    def _lab(b: Bronze):
        return b.spark.sql(sql, p=b.gps_pings(), o=b.shells())


for _name, (_sql, _oracle) in _LAB.items():
    _register_lab(_name, _sql, _oracle)


@query("m14_across_layouts", "select * from (values ('clustered'), ('compacted'), ('partitioned'), "
       "('z_ordered')) as l(layout), (" + " union all ".join(
           f"select '{name}' as query_name, count(*) as n_rows, cast(sum("
           f"{'pings' if name == 'join_heavy' else 'n'}) as bigint) as n_pings from ({oracle})"
           for name, (_, oracle) in _LAB.items()) + ")")
def m14_layouts(b: Bronze):
    """The query set of the lab on pings by day, along a curve and in ranges of the courier."""
    pings = b.gps_pings().withColumn("ping_day", F.to_date("ping_ts"))
    orders, out = b.shells(), None
    for name, write in layout.layouts("ping_day", "courier_id").items():
        path = scratch(b.spark, f"pings-{name}")
        write(pings, path, FILES)
        for key, (sql, _) in _LAB.items():
            n = "pings" if key == "join_heavy" else "n"
            rows = b.spark.sql(sql, p=b.spark.read.parquet(path), o=orders).agg(
                F.count(F.lit(1)).alias("n_rows"), F.sum(n).alias("n_pings")).select(
                F.lit(name).alias("layout"), F.lit(key).alias("query_name"), "n_rows", "n_pings")
            out = rows if out is None else out.unionByName(rows)
    return out


# -- enrichment tables ------------------------------------------------------------------------


@query("d23_enrichment_mart", f"""select review_id, order_id, 'keywords' as model, 'v1'
 as prompt_version, {KEYWORD_SQL} as sentiment from b_reviews
union all select review_id, order_id, 'keywords', 'v2',
 case when {hits_sql(text.NEGATIVE_WORDS)} > 0 then 'negative' else 'positive' end
from b_reviews where lang = 'en'""")
def d23(b: Bronze):
    """Results keyed by review, model and version: a second version adds rows, a repeat does not.
    Partitioned by language and model, so a run over one language leaves the others alone."""
    rows = b.reviews()
    keys = ["review_id", "model", "prompt_version"]

    def result(rows, sentiment, version):
        return rows.select("review_id", "lang", F.lit("keywords").alias("model"),
                           F.lit(version).alias("prompt_version"), sentiment.alias("sentiment"))
    v1 = text.keyword_sentiment(F.col("review_text"))
    v2 = F.when(text.word_hits(F.col("review_text"), text.NEGATIVE_WORDS) > 0, "negative") \
        .otherwise("positive")
    first = result(rows, v1, "v1")
    table = tables.VersionedTable(b.spark, scratch(b.spark, "enrichment"), first.schema,
                                  F.pmod(F.xxhash64("lang"), F.lit(64)))
    table.upsert(first, keys)
    for _ in range(2):
        table.upsert(result(rows.filter("lang = 'en'"), v2, "v2"), keys)
    return table.read().drop("lang").join(rows.select("review_id", "order_id"), "review_id").select(
        "review_id", "order_id", "model", "prompt_version", "sentiment")


@query("d24_embedding_table", """select review_id, model, dim, vector from b_vectors""")
def d24(b: Bronze):
    """A first load of one half, then only what is missing."""
    vectors = b.vectors()
    table = tables.VersionedTable(b.spark, scratch(b.spark, "vectors"), vectors.schema,
                                  F.pmod(F.xxhash64("review_id"), F.lit(4)))
    table.upsert(vectors.filter("cast(review_id as bigint) % 2 = 0"), ["review_id", "model"],
                 update=False)
    for _ in range(2):
        missing = reviews.pending(vectors, table.read(), "review_id", model="fixture-64")
        table.upsert(missing, ["review_id", "model"], update=False)
    return table.read().select("review_id", "model", "dim", "vector")
