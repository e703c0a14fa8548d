"""Spelling variants of words, by PartEnum signatures of their letters.

A word's letters with their numbers of occurrence (the first e, the second e, ...) are a binary vector. One inserted, deleted or replaced letter changes at
most two places of it, so words within one edit have vectors at a Hamming distance of two or less. The places are dealt over ``parts`` parts by a hash. Two
vectors at distance two agree in at least ``parts`` - 2 of the parts; every choice of that many parts, with the word's letters in them, is a signature. Words within one edit thus
share a signature for certain. Signatures are equi-joined, and what meets there is verified by the edit distance itself.

Words are counted by partial sums per task before anything is joined, so that the rest works on a vocabulary. Everything is done with SQL functions.

Defined results: NULL and empty texts have no words. A NULL id counts as empty text in the hash that chooses letters to delete. Rows that repeat an id count each. Long texts are taken whole.
Equal words are one word. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import checkpointed

PARTS, LEAST_LENGTH, LEAST_COUNT, FACTOR, DAMAGE = 8, 6, 5, 5, 199
LETTERS = "[a-zÀ-ÿ]+"


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run) for every run of letters, A-Z lowered."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))


def damaged(found: DataFrame, one_in: int = DAMAGE) -> Column:
    """The run, without one letter where ``one_in`` divides the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(F.col("run"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = DAMAGE) -> DataFrame:
    """(word, n) of words with enough letters and occurrences."""
    long = runs(docs).where(F.length("run") >= least_length)  # no word is longer than its run
    words = long.select(damaged(long, one_in).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def signatures(word: Column, parts: int = PARTS) -> Column:
    """The word's signatures: a hash of each choice of ``parts`` - 2 parts of its vector."""
    letters = F.array_sort(F.split(word, ""))
    places = F.transform(letters, lambda c, i: F.concat(c, (i - F.array_position(letters, c) + 1).cast("string")))
    held = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.array_join(F.filter(places, lambda place: F.pmod(F.xxhash64(place), F.lit(parts)) == p), " ")
    )

    def every(of: Column) -> Column:
        return F.array(*(F.xxhash64(F.lit(i), *(of[p] for p in range(parts) if p not in out)) for i, out in enumerate(combinations(range(parts), 2))))

    # A one-element array makes the parts a value of their own, computed once.
    return F.transform(F.array(held), every)[0]


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, n_a, b, n_b), a before b, of ``words`` (word, n) that differ by exactly one edit."""
    signed = checkpointed(words.select("word", "n", F.explode(signatures(F.col("word"), parts)).alias("signature")), "signatures")
    left = signed.select("signature", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = signed.select("signature", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = left.join(right, "signature").where((F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): where following forms ends. Each step doubles the distance and is written."""
    state = checkpointed(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = checkpointed(state.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        state = step.select("word", "root")
        if not step.where("moved").count():
            return state


def variant_groups(words: DataFrame, factor: int = FACTOR, parts: int = PARTS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n), whose words are distinct."""
    words = checkpointed(words, "words")
    pairs = checkpointed(near_pairs(words, parts), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other")).union(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("minus"), F.col("other").alias("form"))).alias("best"))
    joined = words.join(best, "word", "left")
    taken = -F.col("best.minus") >= factor * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.minus")).alias("form_n")
    )
    formed = checkpointed(formed, "forms")
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the whole table."""
    return variant_groups(vocabulary(docs))


def variants_sql() -> str:
    """``spelling_variants`` in DuckDB's SQL: words within one edit share what is left when a letter is taken out at one place."""
    return f"""
        WITH RECURSIVE crc_table AS (
            SELECT list(v ORDER BY b) AS t FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) AS r(b))),
        found AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{LETTERS}')) AS run FROM documents),
        counted AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS hashed FROM found WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
        bytes AS (SELECT *, list_transform(range(strlen(hashed)), lambda i: CAST('0x' || hex(encode(hashed))[CAST(2 * i + 1 AS INTEGER):CAST(2 * i + 2 AS INTEGER)] AS BIGINT)) AS codes FROM counted),
        crcs AS (
            SELECT run, n, xor(list_reduce(list_prepend(4294967295, codes), lambda crc, c: xor(crc >> 8, t[CAST(xor(crc, c) & 255 AS INTEGER) + 1])), 4294967295) AS h
            FROM bytes, crc_table),
        words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crcs)
            WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
        shorter AS (SELECT word, n, cut, substr(word, 1, cut) || substr(word, cut + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS cut FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS n_other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.cut = b.cut AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, max(n_other) AS top, min(other) FILTER (n_other = most) AS other
            FROM (SELECT *, max(n_other) OVER (PARTITION BY word) AS most FROM near) GROUP BY word),
        formed AS (
            SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= {FACTOR} * w.n THEN b.other END AS form, CASE WHEN b.top >= {FACTOR} * w.n THEN b.top END AS form_n
            FROM words w LEFT JOIN best b USING (word)),
        followed AS (
            SELECT word, word AS root FROM formed
            UNION ALL
            SELECT p.word, f.form FROM followed p JOIN formed f ON f.word = p.root WHERE f.form IS NOT NULL),
        ends AS (SELECT p.word, p.root FROM followed p JOIN formed f ON f.word = p.root WHERE f.form IS NULL)
        SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)"""
