"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Only DataFrame operations. A document's hash puts it into one of ``SLOTS`` slots of its
source; ``SLOTS // BLOCKS`` neighbouring slots are a block. A source with target T and
size S has a quota of blocks: all of them ``floor(T / S)`` times, and as many more as the
rest of the target needs. Each time, the blocks are in an order of their own, drawn by
the seed; the last block of the quota is drawn slot by slot and document by document, in
hash order, until the target is reached.

The quotas are dealt out to the output shards by a binary tree: a node draws, without
replacement, half of its blocks for its left child. How many of them each source gives
is a draw from the multivariate hypergeometric distribution; the counts add up to the
quotas exactly. A draw takes the units with the lowest hashes; the limit is found from
counts in ranges of the hash, so no task sorts all units. The leaves say how many blocks
of each source a shard draws: it has a run of the source's permuted blocks, disjoint from
all other shards', and puts its rows in a random order of its own.

What is sent to all tasks is a row for each source, if there are few enough of them;
otherwise it is joined by a shuffle.

Defined results: a null source is a source of its own and the last one. A null or empty
text has size 0 and takes 0 words. An empty table gives an empty mix. Repeated rows are
rows of their own: where a quota ends among equal rows, so many of them are drawn that
the source is within one of them of its target. Rows keep all their columns, whatever
these are named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, read

SLOTS, BLOCKS = 65_536, 64
MOST_REPEATS = 3
WEIGHTS = (5, 2, 1)
#: More sources than this are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def _facts(docs: DataFrame) -> DataFrame:
    """Source key, size, hash and slot beside ``docs``' columns."""
    return docs.select(
        "*",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("__key"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("__size"),
        F.conv(F.substring(F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("-"), F.coalesce("text", F.lit("")))), 1, 15), 16, 10).cast("bigint").alias("__hash"),
    ).withColumn("__slot", (F.col("__hash") % SLOTS).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to (__key, source, source_size): shares of all sizes by weight,
    none above ``MOST_REPEATS`` times the source's size.

    The excess of capped sources goes to the others by weight. In order of cap to
    weight, those up to some place are capped and the rest share what is left; that
    place is the first whose share does not exceed its own cap. A row per source.
    """
    one = Window.partitionBy(F.lit(0))
    nth = F.row_number().over(one.orderBy(F.col("source").isNull(), "source"))
    weighed = sizes.withColumn("__w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(nth - 1, F.lit(len(weights))) + 1).cast("int")))
    cap = MOST_REPEATS * F.col("source_size")
    by_cap = one.orderBy(cap / F.col("__w"), "__key")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    share = (F.sum("source_size").over(one) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("__w").over(rest)
    ranked = weighed.select("*", share.alias("__share"), F.row_number().over(by_cap).alias("__nth"))
    first = F.min(F.when(F.col("__share") <= cap / F.col("__w"), F.struct("__nth", "__share"))).over(one)
    shared = ranked.withColumn("__first", first)
    target = F.when(F.col("__nth") >= F.col("__first.__nth"), F.col("__w") * F.col("__first.__share")).otherwise(cap.cast("double"))
    return shared.select("__key", "source", "source_size", target.alias("target"))


def _drawn(what: str, seed: int, *columns: str) -> Column:
    """A hash in hexadecimal digits."""
    return F.md5(F.concat_ws("-", F.lit(what), F.lit(seed), *(F.col(c).cast("string") for c in columns)))


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(__key, shard, n): the quotas (__key, n) dealt out to 2**levels shards."""
    nodes = quotas.select(F.lit(1).cast("bigint").alias("node"), "__key", "n")
    for _ in range(levels):
        nodes = materialise(nodes)
        units = nodes.filter("n > 0").select("node", "__key", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
        units = units.withColumn("h", _drawn("node", seed, "node", "__key", "i")).withColumn("range", F.substring("h", 1, 3))
        # The limit lies in the range of hashes where the running count passes the half.
        running = Window.partitionBy("node").orderBy("range")  # at most 2**12 rows of a node
        ranges = units.groupBy("node", "range").agg(F.count(F.lit(1)).alias("c")).select("*", (F.sum("c").over(running) - F.col("c")).alias("before"))
        half = nodes.groupBy("node").agg(F.floor(F.sum("n") / 2).alias("half"))
        ranges = ranges.join(half, "node").filter("before < half")
        inside = units.join(ranges, ["node", "range"])
        nth = F.row_number().over(Window.partitionBy("node", "range").orderBy("h", "__key", "i"))
        whole = inside.filter("before + c <= half").select("node", "__key")
        edge = inside.filter("before + c > half").withColumn("nth", nth).filter("before + nth <= half").select("node", "__key")
        left = whole.union(edge).groupBy("node", "__key").agg(F.count(F.lit(1)).cast("int").alias("x"))
        drawn = nodes.join(left, ["node", "__key"], "left").withColumn("x", F.coalesce("x", F.lit(0)))
        nodes = drawn.select("__key", F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("x").alias("n")), F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("n") - F.col("x")).alias("n")))).alias("child")).select("child.node", "__key", "child.n")
    return nodes.select("__key", (F.col("node") - 2**levels).cast("int").alias("shard"), "n")


def _source_rows(facts: DataFrame, levels: int, weights: tuple[int, ...], seed: int) -> DataFrame:
    """A row for each source: size, target, whole copies, the places of the blocks in each
    copy, where the last copy ends, and after how many blocks each shard has its share."""
    slots = materialise(facts.groupBy("__key", "source", "__slot").agg(F.sum("__size").alias("size")))
    sized = targets(slots.groupBy("__key", "source").agg(F.sum("size").alias("source_size")), weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - F.col("__whole") * F.col("source_size")
    sized = materialise(sized.withColumn("__whole", whole).withColumn("__rest", rest))
    # The order of blocks in each copy, the last of which is drawn in part: at most 4 x BLOCKS rows a source.
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    blocks = sized.select("__key", "__whole", F.explode(F.sequence(F.lit(0), "__whole")).alias("copy")).select("*", block)
    place = F.row_number().over(Window.partitionBy("__key", "copy").orderBy(_drawn("block", seed, "__key", "copy", "block"), "block")) - 1
    placed = materialise(blocks.withColumn("place", place))
    places = placed.groupBy("__key").agg(F.transform(F.sort_array(F.collect_list(F.struct("copy", "block", "place"))), lambda x: x["place"]).alias("__places"))
    last = placed.filter("copy = __whole").select("__key", "block", "place")
    upto = F.sum("size").over(Window.partitionBy("__key").orderBy("place", "__slot"))  # at most SLOTS rows of a source
    edge = (
        slots.filter("size > 0").withColumn("block", (F.col("__slot") / (SLOTS // BLOCKS)).cast("int")).join(last, ["__key", "block"])
        .withColumn("upto", upto).join(sized.select("__key", "__rest"), "__key").filter("upto - size <= __rest and __rest < upto")
        .select("__key", F.col("place").alias("__edge_place"), F.col("__slot").alias("__edge"), (F.col("upto") - F.col("size")).alias("__before"))
    )
    sized = materialise(sized.join(edge, "__key", "left").join(places, "__key"))
    quotas = sized.select("__key", (F.col("__whole") * BLOCKS + F.coalesce(F.col("__edge_place") + 1, F.lit(0))).alias("n"))
    dealt = split_quotas(quotas, levels, seed)
    shares = dealt.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("dealt"))  # a struct for each shard
    ends = F.transform(F.sequence(F.lit(1), F.lit(2**levels)), lambda k: F.aggregate(F.slice("dealt", 1, k), F.lit(0), lambda a, x: a + x["n"]))
    return sized.join(shares, "__key").select(sized["__key"], "source_size", "target", "__whole", "__rest", "__places", "__edge_place", "__edge", "__before", ends.alias("__ends"))


def plan(docs: DataFrame, levels: int = 3, weights: tuple[int, ...] = WEIGHTS, seed: int = 1) -> DataFrame:
    """``docs``' columns with __size, source_size, target as ``__source_size`` and
    ``__target``, and ``__shards``: the shard of each time that the mix takes the row.

    The texts are read twice and not shuffled.
    """
    facts = _facts(docs)
    sources = materialise(_source_rows(facts.select("__key", "source", "__slot", "__size"), levels, weights, seed))
    few = sources.count() <= BROADCAST_SOURCES
    hint = F.broadcast if few else (lambda x: x)
    # Documents of the slot where a source's last copy ends, in order: about one in SLOTS. Equal ones are counted.
    identity = ["__hash", "doc_id", "__size"]
    edge = facts.select("__key", "__slot", *identity).join(hint(sources.select("__key", F.col("__edge").alias("__slot"), "__before", "__rest")), ["__key", "__slot"])
    alike = edge.groupBy("__key", "__before", "__rest", *identity).agg(F.count(F.lit(1)).alias("__alike"))
    upto = F.sum(F.col("__size") * F.col("__alike")).over(Window.partitionBy("__key").orderBy(*identity).rowsBetween(Window.unboundedPreceding, -1))
    room = F.col("__rest") - F.col("__before") - F.coalesce(upto, F.lit(0))
    # Of equal rows, those whose middle is not beyond the end.
    fit = F.when(F.col("__size") == 0, F.when(room >= 0, F.col("__alike"))).otherwise(F.least(F.col("__alike"), F.floor(room / F.col("__size") + 0.5)))
    # The last document that is drawn, if any, gives the end: a hash, a doc_id and a size.
    last = alike.withColumn("__fit", fit).filter("__fit > 0").groupBy("__key").agg(F.max(F.struct(*identity, "__fit", "__alike")).alias("__end"))
    kept = ("source_size", "target", "__whole", "__places", "__edge_place", "__edge", "__ends", "__last", "__fit", "__alike")
    sources = sources.join(last, "__key", "left").select("*", F.struct(*(F.col(f"__end.{c}").alias(c) for c in identity)).alias("__last"), "__end.__fit", "__end.__alike")
    sources = materialise(sources.select("__key", *(F.col(c).alias(f"__s_{c.strip('_')}") for c in kept)))
    both = facts.join(hint(sources), "__key")
    itself = F.struct(*identity)
    at_end = (F.col("__slot") == F.col("__s_edge")) & (itself == F.col("__s_last"))
    if sources.filter("__s_fit < __s_alike").limit(1).count():
        # Equal rows of which some are drawn: numbered through random parts, written down first.
        split = at_end & (F.col("__s_fit") < F.col("__s_alike"))
        equal = materialise(both.filter(split).withColumn("__part", F.floor(F.rand(seed) * 4096).cast("int")))
        sizes = equal.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n"))
        begin = sizes.select("__key", "__part", (F.sum("__n").over(Window.partitionBy("__key").orderBy("__part")) - F.col("__n")).alias("__begin"))
        nth = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__hash")) + F.col("__begin")
        numbered = equal.join(begin, ["__key", "__part"]).withColumn("__ends_here", nth <= F.col("__s_fit")).select(*both.columns, "__ends_here")
        both = both.filter(~F.coalesce(split, F.lit(False))).withColumn("__ends_here", F.lit(True)).union(numbered)
    else:
        both = both.withColumn("__ends_here", F.lit(True))
    block = (F.col("__slot") / (SLOTS // BLOCKS)).cast("int")
    place = F.get("__s_places", F.col("__s_whole") * BLOCKS + block)
    inside = (F.col("__slot") < F.col("__s_edge")) | ((F.col("__slot") == F.col("__s_edge")) & ((itself < F.col("__s_last")) | ((itself == F.col("__s_last")) & F.col("__ends_here"))))
    drawn = (place < F.col("__s_edge_place")) | ((place == F.col("__s_edge_place")) & inside)
    copies = F.col("__s_whole") + F.coalesce(drawn, F.lit(False)).cast("int")

    def shard(copy: Column) -> Column:
        unit = copy * BLOCKS + F.get("__s_places", copy * BLOCKS + block)
        return F.size(F.filter("__s_ends", lambda end: end <= unit))

    shards = F.when(copies > 0, F.transform(F.sequence(F.lit(0), copies - 1), shard)).otherwise(F.array().cast("array<int>"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return both.select(*own, "__size", F.col("__s_source_size").alias("__source_size"), F.col("__s_target").alias("__target"), shards.alias("__shards"))


def mix(docs: DataFrame, levels: int = 3, weights: tuple[int, ...] = WEIGHTS, seed: int = 1) -> DataFrame:
    """The mixed rows: ``docs``' columns, mix_shard, mix_copy and mix_place. Each shard's
    rows are in a random order of their own; shards are spread over several partitions."""
    row = docs.select(F.struct("*").alias("__row"), "doc_id", "source", "text")
    taken = plan(row, levels, weights, seed).select("__row", F.posexplode("__shards").alias("mix_copy", "mix_shard"), "doc_id")
    placed = taken.withColumn("mix_place", F.xxhash64(F.lit(seed), "mix_shard", "mix_copy", "doc_id"))
    parts = placed.repartition("mix_shard", F.pmod("mix_place", F.lit(64))).sortWithinPartitions("mix_shard", "mix_place")
    extra = [F.col(c) for c in ("mix_shard", "mix_copy", "mix_place") if c not in docs.columns]
    return parts.select("__row.*", *extra)


OP9_SQL = r"""
WITH RECURSIVE facts AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '') || '-' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sized AS (SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size FROM facts GROUP BY key, source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         CAST(sum(source_size) OVER () AS BIGINT) AS total FROM sized),
shares AS (
  SELECT *, row_number() OVER by_cap AS nth,
         (total - coalesce(sum(3 * source_size) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / CAST(sum(w) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS share
  FROM weighed WINDOW by_cap AS (ORDER BY 3 * source_size / CAST(w AS DOUBLE), key)),
firsts AS (SELECT min(nth) AS nth FROM shares WHERE share <= 3 * source_size / CAST(w AS DOUBLE)),
goals AS (
  SELECT s.key, s.source_size,
         CASE WHEN s.nth >= f.nth THEN s.w * (SELECT share FROM shares WHERE nth = f.nth) ELSE CAST(3 * s.source_size AS DOUBLE) END AS target
  FROM shares s, firsts f),
ends AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS INTEGER) AS whole FROM goals),
places AS (
  SELECT key, whole, copy, block,
         row_number() OVER (PARTITION BY key, copy ORDER BY md5('block-1-' || key || '-' || copy || '-' || block), block) - 1 AS place
  FROM (SELECT key, whole, unnest(range(whole + 1)) AS copy FROM ends), (SELECT unnest(range(64)) AS block)),
ordered AS (
  SELECT f.doc_id, f.key, f.size, e.source_size, e.target, e.whole, f.h % 65536 AS slot, f.h % 65536 // 1024 AS block, p.place,
         sum(f.size) OVER (PARTITION BY f.key ORDER BY p.place, f.h % 65536, f.h, f.doc_id, f.size ROWS UNBOUNDED PRECEDING) - f.size AS before,
         e.target - e.whole * e.source_size AS rest, row_number() OVER () AS nth
  FROM facts f JOIN ends e USING (key) JOIN places p ON p.key = f.key AND p.copy = e.whole AND p.block = f.h % 65536 // 1024),
drawn AS (SELECT *, whole + CASE WHEN before + size / CAST(2 AS DOUBLE) <= rest THEN 1 ELSE 0 END AS copies FROM ordered),
slots AS (
  SELECT key, place, slot, sum(size) AS size, any_value(rest) AS rest
  FROM ordered GROUP BY key, place, slot HAVING sum(size) > 0),
edges AS (
  SELECT key, place FROM (SELECT *, sum(size) OVER (PARTITION BY key ORDER BY place, slot) AS upto FROM slots)
  WHERE upto - size <= rest AND rest < upto),
quotas AS (SELECT e.key, e.whole * 64 + coalesce(d.place + 1, 0) AS n FROM ends e LEFT JOIN edges d USING (key)),
tree AS (
  SELECT 0 AS level, CAST(1 AS BIGINT) AS node, key, CAST(n AS BIGINT) AS n FROM quotas
  UNION ALL
  SELECT level + 1, 2 * node + side, key, CASE side WHEN 0 THEN x ELSE n - x END
  FROM (
    SELECT level, node, key, any_value(n) AS n, count(*) FILTER (WHERE i > 0 AND nth <= half) AS x
    FROM (
      SELECT *, row_number() OVER (PARTITION BY node, i > 0 ORDER BY md5('node-1-' || node || '-' || key || '-' || i), key, i) AS nth,
             count(*) FILTER (WHERE i > 0) OVER (PARTITION BY node) // 2 AS half
      FROM (SELECT level, node, key, n, unnest(range(n + 1)) AS i FROM tree WHERE level < 3))
    GROUP BY level, node, key), (VALUES (0), (1)) AS sides (side)),
leaves AS (
  SELECT key, node - 8 AS shard, sum(n) OVER (PARTITION BY key ORDER BY node) AS stop, n FROM tree WHERE level = 3),
homes AS (
  SELECT d.nth, string_agg(CAST(l.shard AS VARCHAR), ',' ORDER BY p.copy) AS shards
  FROM drawn d JOIN places p ON p.key = d.key AND p.block = d.block AND p.copy < d.copies
  JOIN leaves l ON l.key = d.key AND p.copy * 64 + p.place < l.stop AND p.copy * 64 + p.place >= l.stop - l.n
  GROUP BY d.nth)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, coalesce(shards, '') AS shards
FROM drawn LEFT JOIN homes USING (nth)
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and for which output shards."""
    planned = plan(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return planned.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__size") * F.size("__shards")).alias("taken"), F.concat_ws(",", F.col("__shards").cast("array<string>")).alias("shards"),
    )
