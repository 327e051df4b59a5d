"""Fill-in-middle transformation over overlapping chunks.

A text's tokens are runs of A-Z and a-z, and every other character alone. So a token begins at each
character but a letter behind a letter: a predicate of two neighbours. Texts are cut into chunks of
bounded size that begin with the last character of the chunk before, and each chunk counts by itself
how many tokens begin in it. Running sums of these counts route both cut ranks to the chunks that own
them, and only those are scanned again for the place of their cut. All of it is column expressions on
one row: no row is shuffled, and a text of any length is held a few times over, in pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Characters of a chunk, without the one that it shares.
CHUNK = 1024
#: What marks prefix, suffix and middle in an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of documents that stay plain, and of the rest those with the suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20

_TOKEN = "[A-Za-z]+|[^A-Za-z]"
_BEHIND_A_LETTER = "(?<=[A-Za-z])[A-Za-z]+"


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the hex SHA-256 of `seed:doc_id` (null: nothing behind the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def chunked(text: Column, chunk: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))


def overlapping(chunks: Column) -> Column:
    """Each chunk behind the last character of the one before."""
    last = F.transform(chunks, lambda c: F.right(c, F.lit(1)))
    before = F.slice(F.concat(F.array(F.lit("")), last), F.lit(1), F.size(chunks))
    return F.zip_with(before, chunks, lambda b, c: F.concat(b, c))


def _shared(i: Column) -> Column:
    return F.when(i > 0, 1).otherwise(0)


def begun(overlapped: Column) -> Column:
    """Tokens that begin in each chunk, and its characters; the shared one counts in the chunk before."""
    return F.transform(overlapped, lambda c, i: F.struct((F.length(F.regexp_replace(c, _BEHIND_A_LETTER, "")) - _shared(i)).cast("long").alias("tokens"), (F.length(c) - _shared(i)).cast("long").alias("chars")))


def owner(counts: Column, rank: Column) -> Column:
    """The chunk in which token number `rank` begins (null: behind the last token), with what lies before it."""
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("tokens"), F.lit(0).cast("long").alias("chars"), F.lit(False).alias("found"))

    def step(at: Column, x: Column) -> Column:
        here = at["found"] | (at["tokens"] + x["tokens"] > rank)
        on = lambda name, more: F.when(here, at[name]).otherwise(at[name] + more)
        return F.struct(on("i", F.lit(1)).alias("i"), on("tokens", x["tokens"]).alias("tokens"), on("chars", x["chars"]).alias("chars"), here.alias("found"))

    return F.aggregate(counts, zero, step)


def place(overlapped: Column, at: Column, rank: Column) -> Column:
    """Characters before token number `rank`: the owner is scanned for it, no other chunk is."""
    c, shared = F.get(overlapped, at["i"]), _shared(at["i"])
    skipped = F.slice(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), F.lit(1), (rank - at["tokens"] + shared).cast("int"))
    return at["chars"] + F.when(at["found"], F.length(F.array_join(skipped, "")) - shared).otherwise(0)


def fill_in_middle(docs: DataFrame, seed: int = 1, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    Form is plain (the text itself), psm (prefix, suffix, middle) or spm (suffix first). Empty and null
    texts and those that hold a mark stay plain, and so do 10 % of the others; their character counts are null.
    Both cuts are uniform over the places between tokens and depend on seed and doc_id alone, so
    rows of equal id and text give equal rows; a null id draws as an empty one. Texts of any length
    are cut over all of their tokens. Other columns are not read, whatever their names. No rows in, no rows out.
    """
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("chunks", chunked(F.col("text"), chunk)).withColumn("chunks", overlapping(F.col("chunks"))).withColumn("counts", begun(F.col("chunks")))
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    t = t.withColumn("n", n).withColumn("r1", F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))).withColumn("r2", F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = F.when((F.col("text") == "") | marked | (h3 % 100 >= PLAIN_FROM), "plain").when(h4 % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    t = t.withColumn("form", form)
    for k in ("1", "2"):
        # the places of plain documents are asked by nobody
        t = t.withColumn(f"o{k}", F.when(F.col("form") != "plain", owner(F.col("counts"), F.col(f"r{k}")))).withColumn(f"p{k}", place(F.col("chunks"), F.col(f"o{k}"), F.col(f"r{k}")))
    prefix, middle, suffix = F.substring("text", F.lit(1), F.col("p1").cast("int")), F.substring("text", (F.col("p1") + 1).cast("int"), (F.col("p2") - F.col("p1")).cast("int")), F.substring("text", (F.col("p2") + 1).cast("int"), F.length("text"))
    psm, spm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle), F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return t.select("doc_id", "n", "form", F.col("p1").alias("prefix_chars"), (F.col("p2") - F.col("p1")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone: texts that hold a mark stay plain, so each mark's first place is its own."""

    def parts(second: str) -> tuple[Column, Column, Column]:
        a = F.substring_index(F.substring(output, F.lit(4), F.length(output)), second, 1)
        rest = F.substring(output, F.length(a) + 7, F.length(output))
        b = F.substring_index(rest, MIDDLE, 1)
        return a, b, F.substring(rest, F.length(b) + 4, F.length(output))

    prefix, suffix, middle = parts(SUFFIX)
    suffix_2, prefix_2, middle_2 = parts(PREFIX)
    return F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix)).otherwise(F.concat(prefix_2, middle_2, suffix_2))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Every document of the table as fill-in-middle output, by digest, with the text that comes back from it."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def duckdb_sql() -> str:
    part = lambda a, b: f"array_to_string(list_slice(tok, {a}, {b}), '')"
    number = lambda i: f"CAST('0x' || substr(hex, {8 * i + 1}, 8) AS BIGINT)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_TOKEN}') AS tok, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
h AS (SELECT *, len(tok)::BIGINT AS n, {', '.join(f'{number(i)} AS h{i + 1}' for i in range(4))} FROM t),
r AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
 CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, {part('1', 'a')} AS pre, {part('a + 1', 'b')} AS mid, {part('b + 1', 'n')} AS suf FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
