"""Page views, step conversion and top provinces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnstream.functions.scalar import half_even_percent, ip_to_long
from learnstream.operators.state import merge, update_existing

# Page 1 is the course home page, 2 the order page, 3 payment.
HOME, ORDER, PAYMENT = 1, 2, 3
HOME_RATE = "100%"
TOP_PROVINCES = 3
IP_BUCKET_BITS = 16            # ranges and IPs meet in /16 blocks


def jump_count(rows: DataFrame) -> DataFrame:
    """Views per (last, page, next) transition."""
    return rows.groupBy("last_page_id", "page_id", "next_page_id").agg(
        F.count(F.lit(1)).alias("num"))


def view_total_from_counts(counts: DataFrame) -> DataFrame:
    """A8 from A7: views per page id summed over its transitions (integer
    page ids only; others are rejects)."""
    t = counts.withColumn("pid", F.col("page_id").try_cast("int"))
    return (t.where(F.col("pid").isNotNull()).groupBy(F.col("pid").alias("page_id"))
            .agg(F.sum("num").cast("long").alias("num")))


def view_total(rows: DataFrame) -> DataFrame:
    """Views per page id."""
    return view_total_from_counts(jump_count(rows))


def convert_rate(totals: DataFrame) -> DataFrame:
    """Home page gets 100%; order page n2/n1; payment page n3/n2, as
    whole-percent text rounded half to even, 0% on a zero denominator; other
    pages no rate. The three counts are one row, a scalar subquery over the page totals."""
    def n_of(p):
        return F.coalesce(F.sum(F.when(F.col("page_id") == p, F.col("num"))), F.lit(0)).cast("long")
    n = totals.agg(F.struct(n_of(HOME).alias("n1"), n_of(ORDER).alias("n2"), n_of(PAYMENT).alias("n3")).alias("n")).scalar()
    rate = (F.when(F.col("page_id") == HOME, F.lit(HOME_RATE))
            .when(F.col("page_id") == ORDER, half_even_percent(n["n2"], n["n1"]))
            .when(F.col("page_id") == PAYMENT, half_even_percent(n["n3"], n["n2"])))
    return totals.select("page_id", "num", rate.alias("jump_rate"))


def _blocks() -> Column:
    """The /16 blocks a range touches."""
    return F.sequence(F.shiftright("ip_from", IP_BUCKET_BITS), F.shiftright("ip_to", IP_BUCKET_BITS))


def flatten(ranges: DataFrame) -> DataFrame:
    """Nested and overlapping ranges -> disjoint ones of the most specific province:
    every address goes to the smallest range that holds it (ties: the smaller start, then
    the province's name). A range with ``ip_from`` behind ``ip_to``, or a null end, holds nothing.

    Ranges are cut at /16 blocks; a block's starts and ends cut it into pieces, a range
    names the pieces from its own start to its own end, and a piece keeps the smallest
    range that names it. Work is the number of pieces times the ranges around a piece: for
    nested ranges, their depth."""
    b = IP_BUCKET_BITS
    cut = (ranges.where("ip_from <= ip_to").select("*", F.explode(_blocks()).alias("block"))
           .select("block", F.greatest(F.col("ip_from"), F.shiftleft("block", b)).alias("low"),
                   (F.least(F.col("ip_to"), F.shiftleft(F.col("block") + 1, b) - 1) + 1).alias("high"),
                   F.struct((F.col("ip_to") - F.col("ip_from")).alias("size"), "ip_from", "province").alias("own")))
    edges = cut.select("block", F.explode(F.array("low", "high")).alias("at")).distinct()
    order = Window.partitionBy("block").orderBy("at")
    pieces = edges.select("block", "at", F.row_number().over(order).alias("piece"), F.lead("at").over(order).alias("next"))
    first = pieces.select("block", F.col("at").alias("low"), F.col("piece").alias("i"))
    last = pieces.select("block", F.col("at").alias("high"), F.col("piece").alias("j"))
    named = cut.join(first, ["block", "low"]).join(last, ["block", "high"])
    named = named.select("block", F.explode(F.sequence(F.col("i"), F.col("j") - 1)).alias("piece"), "own")
    best = named.groupBy("block", "piece").agg(F.min("own").alias("own"))
    return best.join(pieces, ["block", "piece"]).select(
        F.col("own.province").alias("province"), F.col("at").alias("ip_from"), (F.col("next") - 1).alias("ip_to"))


def locate(ip_counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Attach the province whose ``[ip_from, ip_to]`` holds ``ip_num``
    (inner: IPs outside every range drop). Ranges are disjoint (``flatten`` makes
    them so), so an IP's
    range is the last that starts at or before it: ranges, once per /16 block
    they touch, and distinct IPs are ordered in their block. A block holds at
    most 65,536 IPs and as many ranges."""
    b = IP_BUCKET_BITS
    blocks = F.explode(_blocks())
    span = F.struct("province", "ip_to")
    starts = (ranges.select("*", blocks.alias("bucket"))
              .select("bucket", F.greatest(F.col("ip_from"), F.shiftleft("bucket", b)).alias("at"),
                      span.alias("span"), F.lit(None).cast("long").alias("ip_num"),
                      F.lit(None).cast("long").alias("c")))
    points = ip_counts.select(F.shiftright("ip_num", b).alias("bucket"), F.col("ip_num").alias("at"),
                              F.lit(None).cast(starts.schema["span"].dataType).alias("span"), "ip_num", "c")
    w = Window.partitionBy("bucket").orderBy("at", F.col("ip_num").asc_nulls_first())
    found = starts.unionByName(points).withColumn("last", F.last("span", ignorenulls=True).over(w))
    return (found.where(F.col("ip_num") <= F.col("last.ip_to"))
            .select("ip_num", "c", F.col("last.province").alias("province")))


def province_clicks(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """A10 before the top-k: clicks per province. Clicks are counted per IP
    first (map-side combined), so only distinct IPs meet the ranges."""
    ips = rows.select(ip_to_long(F.col("ip")).alias("ip_num")).where(F.col("ip_num").isNotNull())
    ips = ips.groupBy("ip_num").agg(F.count(F.lit(1)).alias("c"))
    return locate(ips, ranges).groupBy("province").agg(F.sum("c").cast("long").alias("n"))


def province_top(rows: DataFrame, ranges: DataFrame, k: int = TOP_PROVINCES) -> DataFrame:
    """A10: the k provinces with most clicks (ties by name); a
    TakeOrderedAndProject, no global sort."""
    return top_of(province_clicks(rows, ranges), k)


def top_of(clicks: DataFrame, k: int = TOP_PROVINCES) -> DataFrame:
    return clicks.orderBy(F.desc("n"), F.asc("province")).limit(k)


# ---- state and incremental merge ------------------------------------------

def merge_totals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge M (accumulate) for page totals."""
    return merge(old, new, ["page_id"], accumulate=["num"])


def page_batch(counts: DataFrame) -> DataFrame:
    """A batch's row per page id: views, the neighbours (of the smallest
    transition, as text), and the rate a page gets on its first insert (S10)."""
    t = counts.withColumn("pid", F.col("page_id").try_cast("int")).where(F.col("pid").isNotNull())
    first = F.min(F.struct("last_page_id", "next_page_id"))
    rows = t.groupBy(F.col("pid").alias("page_id")).agg(F.sum("num").cast("long").alias("num"), first.alias("f"))
    return rows.select(F.col("f.last_page_id").alias("last_page_id"), "page_id",
                       F.col("f.next_page_id").alias("next_page_id"), "num",
                       F.when(F.col("page_id") == HOME, F.lit(HOME_RATE)).alias("jump_rate"))


def merge_pages(old: DataFrame, new: DataFrame) -> DataFrame:
    """Page state of ``old`` and a batch: views add up, neighbours and the
    rate of the first insert stay (S9); then the rates of the stored pages
    are set from the new totals, of existing pages only (S11)."""
    merged = merge(old, new, ["page_id"], accumulate=["num"],
                   keep_first=["last_page_id", "next_page_id", "jump_rate"])
    rates = convert_rate(merged.select("page_id", "num")).where("jump_rate IS NOT NULL")
    return update_existing(merged, rates, ["page_id"], ["jump_rate"]).select(
        "last_page_id", "page_id", "next_page_id", "num", "jump_rate")
