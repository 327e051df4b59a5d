"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, natively.

Each source's documents are put in a seeded random order, pass by pass, and cut into blocks of
words; its quota is a whole number of blocks but for the last one. A binary tree splits the quotas
among the output shards: at each node half of the blocks, of whatever source, go left. How many of
each source do follows the multivariate hypergeometric law, drawn by halving the list of sources
again and again (one univariate draw for each half), so every shard is a draw without replacement
from the mix. A leaf owns a range of each source's permuted blocks; children cut their parent's
range, so ranges are disjoint. A document is taken as often as shards own blocks that it begins in,
and within a shard draws are ordered by a hash of their own.

The tree works on counts only: a row per node with a long for each source. It grows with the words
of the mix (SHARD_WORDS), the blocks with the shards. Documents are never gathered: their places
in the order are prefix sums over small ranges of the hash, so a source that holds a third of all
documents is spread like any other. Sources themselves are one row each in one task: meant for up
to some hundred thousand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .store import materialize, numbered
from .textkit import count_words_sql, words_sql

#: Weights of the sources in code point order, repeating; null last.
WEIGHTS = (5, 2, 1)
#: Words of the mix against all words, and the most that it takes of a source, times its size.
SHARE, MOST = 1.5, 2
#: Words of an output shard, about, and the least levels of the tree: there are 2**levels shards.
SHARD_WORDS, LEAST_LEVELS = 1 << 24, 3
#: Blocks of a shard, about; a block has at least LEAST_BLOCK words.
SHARD_BLOCKS, LEAST_BLOCK = 64, 1024
#: Documents, or blocks, of one range of the hash, about, and ranges that are summed up together.
RANGE_ROWS, RANGES = 4096, 4096
#: Levels of the tree in one plan.
PLAN_LEVELS = 4


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, rows, number, target) from (source, size).

    With a cap of most * size, the shares that remain after resharing all excess are
    least(cap, level * weight) for one level: sources are capped in order of cap / weight until
    the level of the others is below the next one's. The windows run over one row per source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by = by.withColumn("number", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    by = by.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size").cast("double") * most)
    order = W.orderBy(F.col("cap") / F.col("weight"), "number")
    before, all_rows = order.rowsBetween(W.unboundedPreceding, -1), W.orderBy("number").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    whole = F.sum("source_size").over(all_rows) * F.lit(share)
    level = (whole - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    by = by.withColumn("level", level)
    first = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("number")))
    by = by.withColumn("level", F.min_by("level", first).over(all_rows))
    return by.select("source", "source_size", "rows", "number", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")).alias("target"))


def _draw(whole: str, marked: str, taken: str, chance: str) -> str:
    """SQL for a hypergeometric draw: how many of `taken` items out of `whole` are among `marked`.

    The law's sum is inverted over ten standard deviations on either side of its mean; beyond lies
    less than the chance's resolution.
    """
    step = "ln((z.m - k) * 1D * (z.t - k)) - ln((k + 1D) * (z.n - z.m - z.t + k + 1))"
    walk = "sequence(z.a, z.b - 1)"
    top = f"aggregate({walk}, struct(0D AS w, 0D AS top), (s, k) -> struct(s.w + {step} AS w, greatest(s.top, s.w + {step}) AS top), s -> s.top)"
    total = f"aggregate({walk}, struct(0D AS w, exp(-y) AS sum), (s, k) -> struct(s.w + {step} AS w, s.sum + exp(s.w + {step} - y) AS sum), s -> s.sum)"
    pick = f"aggregate({walk}, struct(0D AS w, exp(-y) AS sum, z.a AS at), (s, k) -> struct(s.w + {step} AS w, s.sum + exp(s.w + {step} - y) AS sum, CASE WHEN s.sum < z.u * total THEN k + 1 ELSE s.at END AS at), s -> s.at)"
    inverse = f"transform(array({top}), y -> transform(array({total}), total -> {pick})[0])[0]"
    let = lambda name, fields, then: f"transform(array({fields}), {name} -> {then})[0]"
    spread = "cast(10 * sqrt(v.t * 1D * v.m / v.n * (v.n - v.m) / v.n * (v.n - v.t) / (v.n - 1)) AS bigint) + 20"
    around = let("x", f"struct(v.n AS n, v.m AS m, v.t AS t, v.u AS u, v.low AS low, v.high AS high, cast(v.t * 1D * v.m / v.n AS bigint) AS mean, {spread} AS far)", let("z", "struct(x.n AS n, x.m AS m, x.t AS t, x.u AS u, greatest(x.low, x.mean - x.far) AS a, least(x.high, x.mean + x.far) AS b)", inverse))
    given = f"struct({whole} AS n, {marked} AS m, {taken} AS t, {chance} AS u, greatest(0L, {taken} + {marked} - {whole}) AS low, least({marked}, {taken}) AS high)"
    return let("v", given, f"CASE WHEN v.low >= v.high THEN v.low ELSE {around} END")


def _split(nodes: DataFrame, seed: int, level: int, depth: int) -> DataFrame:
    """nodes (shard, counts, starts; 2**depth counts) with a column left: the counts of the left half."""
    nodes = nodes.select("shard", "starts", F.col("counts").alias("s0"))
    for k in range(depth):
        pair = f"transform(sequence(0, {2 ** (depth - k - 1) - 1}), i -> s{k}[2 * i] + s{k}[2 * i + 1])"
        nodes = nodes.withColumn(f"s{k + 1}", F.expr(pair))
    nodes = nodes.withColumn("t", F.expr(f"array(s{depth}[0] DIV 2)"))
    for k in range(depth, 0, -1):
        chance = f"(conv(substr(md5(concat_ws(':', '{seed}', 'split', {level}, shard, {k}, i)), 1, 12), 16, 10) + 0.5D) / {2.0**48}D"
        draw = _draw(f"s{k}[i]", f"s{k - 1}[2 * i]", "t[i]", chance)
        nodes = nodes.withColumn("t", F.expr(f"flatten(transform(sequence(0, {2 ** (depth - k) - 1}), i -> transform(array({draw}), d -> array(d, t[i] - d))[0]))"))
    return nodes.select("shard", F.col("s0").alias("counts"), "starts", F.col("t").alias("left"))


def splitting_tree(quotas: DataFrame, seed: int, levels: int, sources: int) -> DataFrame:
    """(shard, counts, starts) from one row with counts, the blocks of each source, by number.

    starts is where each source's range of permuted blocks begins.
    """
    depth = max(1, (sources - 1).bit_length())
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), F.expr(f"concat(counts, array_repeat(0L, {2**depth} - size(counts)))").alias("counts"), F.expr(f"array_repeat(0L, {2**depth})").alias("starts"))
    for level in range(levels):
        nodes = _split(nodes, seed, level, depth)
        more = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
        rest = F.zip_with("counts", "left", lambda x, y: x - y)
        half = lambda right, counts, starts: F.struct((F.col("shard") * 2 + right).alias("shard"), counts.alias("counts"), starts.alias("starts"))
        nodes = nodes.select(F.explode(F.array(half(0, F.col("left"), F.col("starts")), half(1, rest, more("starts", "left")))).alias("half")).select("half.*")
        if level % PLAN_LEVELS == PLAN_LEVELS - 1 and level < levels - 1:
            nodes = materialize(nodes.repartition("shard"), "nodes")
    return nodes


def _in_order(df: DataFrame, weight: str, ties: list[str]) -> DataFrame:
    """df (number, key, rows, ...) with `at`: the weights before it in its number, by key (an MD5) and ties.

    rows is how many rows a number has. Sums go by ranges of the key, so no task sees a whole number.
    """
    df = df.withColumn("part", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 2.0**32 * F.ceil(F.col("rows") / RANGE_ROWS)).cast("long"))
    parts = df.groupBy("number", "part").agg(F.sum(weight).alias("sum")).withColumn("many", F.expr(f"part DIV {RANGES}"))
    prefix = lambda *over: F.sum("sum").over(W.partitionBy(*over[:-1]).orderBy(over[-1])) - F.col("sum")
    wide = parts.groupBy("number", "many").agg(F.sum("sum").alias("sum")).withColumn("base", prefix("number", "many")).drop("sum")
    parts = parts.withColumn("within", prefix("number", "many", "part")).join(wide, ["number", "many"]).select("number", "part", (F.col("base") + F.col("within")).alias("before"))
    order = W.partitionBy("number", "part").orderBy("key", *ties).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.join(parts, ["number", "part"]).withColumn("at", F.col("before") + F.sum(weight).over(order) - F.col(weight))


def mix(sizes: DataFrame, seed: int = 7, levels: int | None = None) -> DataFrame:
    """One row per row of sizes (doc_id, source, size): with source_size, target, taken and draws.

    taken is the number of words that all shards together take, repeats counted; a source's taken
    words are its target rounded down, and no document gives more than MOST times its size. draws
    lists the passes in which a shard takes it, by shard: shard, place in the shard, words, block.
    The document at the end of a quota gives only its first words. levels sets the number of shards
    to 2**levels; by default it follows the words. Null sources are a source of their own, placed
    last; documents without words take nothing. A null id is an id. Rows that are equal are
    interchangeable, each is drawn for itself. Empty in, empty out. A column `row` that tells rows
    apart is kept; without one, rows get one.
    """
    given = sizes if "row" in sizes.columns else sizes.withColumn("row", F.monotonically_increasing_id())
    sizes = materialize(given.select("row", "doc_id", "source", "size"), "sizes")
    by = targets(sizes).withColumn("quota", F.floor("target").cast("long"))
    all_words, n = by.agg(F.sum("quota"), F.count("*")).first()
    if levels is None:
        levels = max(LEAST_LEVELS, (-(-(all_words or 0) // SHARD_WORDS) - 1).bit_length())
    block_words = max(LEAST_BLOCK, -(-(all_words or 0) // (SHARD_BLOCKS << levels)))
    by = by.withColumn("blocks", F.expr(f"(quota + {block_words - 1}) DIV {block_words}"))
    by = materialize(by, "sources")
    quotas = by.groupBy().agg(F.transform(F.sort_array(F.collect_list(F.struct("number", "blocks"))), lambda x: x["blocks"]).alias("counts"))
    leaves = splitting_tree(quotas, seed, levels, max(1, n)).select("shard", F.posexplode(F.arrays_zip("counts", "starts")).alias("number", "own")).filter("own.counts > 0")
    owned = leaves.select("number", F.explode(F.expr("sequence(own.starts, own.starts + own.counts - 1)")).alias("at"), "shard")
    blocks = by.filter("blocks > 0").select("number", F.col("blocks").alias("rows"), F.lit(1).cast("long").alias("one"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    blocks = blocks.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("block"), "number", "block")))
    owners = materialize(_in_order(blocks, "one", ["block"]).select("number", "block", "at").join(owned, ["number", "at"]).select("number", "block", "shard"), "owners")

    side = by.withColumnRenamed("source", "__source")
    rows = sizes.join(side, sizes["source"].eqNullSafe(side["__source"])).drop("__source")
    rows = _in_order(rows.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), "doc_id", "source"))), "size", ["doc_id", "size", "row"])
    rows = materialize(rows.select("row", "doc_id", "source", "size", "source_size", "target", "number", "quota", "at"), "places")

    asked = rows.select("row", "doc_id", "size", "number", "quota", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))).alias("pass"), (F.col("at") + F.col("pass") * F.col("source_size")).alias("start"))
    asked = asked.withColumn("words", F.least("size", F.col("quota") - F.col("start"))).filter("words > 0").withColumn("block", F.expr(f"start DIV {block_words}"))
    asked = asked.select("row", "number", "words", "block", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("place"), "pass", "doc_id")).alias("place"))
    drawn = asked.join(owners, ["number", "block"]).groupBy("row").agg(F.sum("words").alias("taken"), F.sort_array(F.collect_list(F.struct("shard", "place", "words", "block"))).alias("draws"))  # at most MOST
    none = F.array().cast("array<struct<shard:bigint,place:string,words:bigint,block:bigint>>")
    out = rows.join(drawn, "row", "left")
    return out.select("row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("draws", none).alias("draws"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, levels: int | None = None) -> DataFrame:
    """The mix itself: docs with one row per draw, by shard and, within it, by place.

    A draw of part of a document has its first words, joined by a space. A shard's rows lie in runs
    of sorted places, so that many tasks write one shard. Repeated rows, null ids, null texts and
    columns of any name are kept apart by a row number; null and wordless texts are never drawn.
    Very long texts are drawn like others, whole but for the last of a source. Empty in, empty out.
    """
    held = numbered(docs)
    size = F.expr(count_words_sql(f"doc.`{text_col}`")).cast("long")
    drawn = mix(held.select("row", F.col(f"doc.`{id_col}`").alias("doc_id"), F.col(f"doc.`{source_col}`").alias("source"), size.alias("size")), seed, levels)
    drawn = drawn.filter("taken > 0").select("row", "size", F.explode("draws").alias("draw"))
    both = held.join(drawn, "row")
    both = both.repartition(F.col("draw.shard"), F.substring("draw.place", 1, 1)).sortWithinPartitions("draw.shard", "draw.place")
    part = F.expr(f"array_join(slice({words_sql(f'doc.`{text_col}`')}, 1, cast(draw.words AS int)), ' ')")
    cell = lambda c: F.col(f"doc.`{c}`")
    text = F.when(F.col("draw.words") < F.col("size"), part).otherwise(cell(text_col))
    return both.select(*((text if c == text_col else cell(c)).alias(c) for c in docs.columns))


def _size(text_col: str = "text") -> Column:
    return F.expr(count_words_sql(f"`{text_col}`")).cast("long")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Words that the mix's shards take of every document, all together and (draws) one by one as shard:words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    listed = F.array_join(F.transform("draws", lambda x: F.concat_ws(":", x["shard"], x["words"])), ",")
    return mix(docs.select("doc_id", "source", _size().alias("size"))).select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken", listed.alias("draws"))


def duckdb_sql(seed: int = 7, levels: int = LEAST_LEVELS, depth: int = 6) -> str:
    """The same mix, tree included, for up to 2**depth sources and as many words as LEAST_LEVELS serves.

    The law is written with factorials here, not by ratios.
    """
    lf = lambda a, b: f"lgamma({a} + 1.0) - lgamma({b} + 1.0) - lgamma({a} - {b} + 1.0)"
    tree = ["c0 AS (SELECT 0::BIGINT AS shard, number, blocks AS n, 0::BIGINT AS start FROM q)"]
    for x in range(levels):
        tree.append(f"s{x} AS MATERIALIZED (SELECT shard, k, number >> k AS i, sum(n)::BIGINT AS w FROM c{x}, range({depth + 1}) r(k) GROUP BY ALL)")
        tree.append(f"t{x}_{depth} AS (SELECT shard, 0::BIGINT AS i, w // 2 AS t FROM s{x} WHERE k = {depth})")
        for k in range(depth, 0, -1):
            tree.append(f"""a{x}_{k} AS (SELECT t.shard, t.i, t.t, p.w, coalesce(l.w, 0) AS m, ('0x' || substr(md5(concat_ws(':', '{seed}', 'split', {x}, t.shard, {k}, t.i)), 1, 12))::BIGINT AS h,
 greatest(0, t.t + coalesce(l.w, 0) - p.w) AS low, least(coalesce(l.w, 0), t.t) AS high FROM t{x}_{k} t JOIN s{x} p ON p.shard = t.shard AND p.k = {k} AND p.i = t.i LEFT JOIN s{x} l ON l.shard = t.shard AND l.k = {k - 1} AND l.i = 2 * t.i),
b{x}_{k} AS (SELECT *, unnest(range(low, high + 1)) AS j FROM a{x}_{k}),
l{x}_{k} AS (SELECT *, {lf('m', 'j')} + {lf('(w - m)', '(t - j)')} AS l FROM b{x}_{k}),
e{x}_{k} AS (SELECT *, exp(l - max(l) OVER (PARTITION BY shard, i)) AS p FROM l{x}_{k}),
f{x}_{k} AS (SELECT *, sum(p) OVER (PARTITION BY shard, i ORDER BY j) AS cum, sum(p) OVER (PARTITION BY shard, i) AS whole FROM e{x}_{k}),
d{x}_{k} AS MATERIALIZED (SELECT shard, i, any_value(t) AS t, min(j) FILTER (cum >= (h + 0.5::DOUBLE) / {2.0**48}::DOUBLE * whole) AS x FROM f{x}_{k} GROUP BY shard, i),
t{x}_{k - 1} AS (SELECT shard, 2 * i AS i, x AS t FROM d{x}_{k} UNION ALL SELECT shard, 2 * i + 1, t - x FROM d{x}_{k})""")
        tree.append(f"""c{x + 1} AS MATERIALIZED (SELECT 2 * c.shard AS shard, number, t AS n, start FROM c{x} c JOIN t{x}_0 t ON t.shard = c.shard AND t.i = number
 UNION ALL SELECT 2 * c.shard + 1, number, n - t, start + t FROM c{x} c JOIN t{x}_0 t ON t.shard = c.shard AND t.i = number)""")
    return rf"""
WITH s AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size FROM documents),
b AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM s GROUP BY source),
w AS (SELECT *, ([5.0::DOUBLE, 2, 1])[(number % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM b),
l AS (SELECT *, ((SELECT sum(source_size) FROM w) * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0)) / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER o, 0)) AS level
 FROM w WINDOW o AS (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS MATERIALIZED (SELECT source, number, source_size, least(cap, coalesce((SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, number LIMIT 1) * weight, cap)) AS target FROM l),
bw AS (SELECT greatest({LEAST_BLOCK}, (sum(floor(target)::BIGINT) + {(SHARD_BLOCKS << levels) - 1}) // {SHARD_BLOCKS << levels})::BIGINT AS block_words FROM t),
q AS MATERIALIZED (SELECT *, floor(target)::BIGINT AS quota, (floor(target)::BIGINT + block_words - 1) // block_words AS blocks FROM t, bw),
{', '.join(tree)},
p AS (SELECT s.*, q.source_size, target, number, quota, block_words, sum(size) OVER (PARTITION BY s.source ORDER BY md5(concat_ws(':', '{seed}', doc_id, s.source)), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS pos FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source),
y AS (SELECT p.*, turn, pos + turn * source_size AS first_word, least(size, quota - (pos + turn * source_size)) AS words FROM p, range({MOST}) r(turn)),
k AS (SELECT number, block, row_number() OVER (PARTITION BY number ORDER BY md5(concat_ws(':', '{seed}', 'block', number, block)), block) - 1 AS slot FROM q, unnest(range(blocks)) r(block)),
z AS (SELECT y.*, slot FROM y JOIN k ON k.number = y.number AND block = first_word // block_words WHERE words > 0),
o AS (SELECT z.doc_id, c.shard, z.words, md5(concat_ws(':', '{seed}', 'place', turn, z.doc_id)) AS place FROM z JOIN c{levels} c ON c.number = z.number AND z.slot >= c.start AND z.slot < c.start + c.n),
g AS (SELECT doc_id, sum(words)::BIGINT AS taken, string_agg(shard || ':' || words, ',' ORDER BY shard, place) AS draws FROM o GROUP BY doc_id)
SELECT doc_id, size, source_size, round(target, 4) AS target, coalesce(taken, 0)::BIGINT AS taken, coalesce(draws, '') AS draws FROM p LEFT JOIN g USING (doc_id)"""
