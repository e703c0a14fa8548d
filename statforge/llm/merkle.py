"""A Merkle manifest of a table of documents, checked by a recursive climb.

Every document is a leaf: a hash of its fields. Per source, leaves in the order of their ids are hashed in runs of ``FAN``, and so are the results, until one is left, the subroot;
the subroots, in the order of their sources, are hashed alike to the root.

Leaves are range-sorted by source and id and written; a leaf's place in its source follows from its place in its task and one count per task and source, so that no source is
sorted or counted by one task. The levels are built by grouping places, at most ``FAN`` children a group, and stored as node rows that name their parent.

The climb is a recursive query of Spark over these rows. One climber stands for a run of leaves. What its leaves share, the siblings above the run, is appended once; what they don't, the hash folded
from each leaf as it is found now, is folded leaf by leaf. Every step joins the climbers to their parents' rows. Many climbers meet at
a high node, so a parent's row is copied for every ``_PER_COPY`` climbers below it, and the climbers are dealt out over the copies. A climber's row has at most
``FAN`` hashes a level, and only one row a run climbs, so that the rows of all levels are smaller than the texts.

Defined results: a field is ``-`` if NULL, else its UTF-8 byte count, a colon and its value, so NULL and empty differ. NULL ids and NULL sources come first. Rows of a source with
equal ids are ordered by their leaf hash; rows that are equal altogether are leaves each. Extra columns are no part of a leaf. An empty table has no root and gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.shared import checkpointed
from statforge.operators.ranking import numbered

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOCAL_BITS = 33  # of monotonically_increasing_id()
_PER_COPY = 1024
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
_NODE = ("tree", "level", "idx", "total", "hash", "kids", "runs")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(field(values[name]) for name in FIELDS)).cast("binary"), 256)


def tampered(docs: DataFrame) -> Column:
    """The text of ``docs`` with A-Z lowered where 5 divides the crc32 of the id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))


def _width(total: Column, level: Column | int) -> Column:
    """How many nodes a tree of ``total`` leaves has at a level."""
    return F.ceil(total / F.pow(F.lit(float(FAN)), F.lit(level) if isinstance(level, int) else level)).cast("bigint")


def runs_of_leaves(docs: DataFrame, found: Column) -> DataFrame:
    """Runs of at most ``FAN`` leaves: (tree, total, idx, members), members ordered as (place, doc_id, leaf, now).

    ``tree`` is the source's rank, ``total`` its number of leaves, ``now`` the hash with the text as ``found``.
    """
    stored = {name: F.col(name) for name in FIELDS}
    hashes = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf_hash(stored).alias("leaf"), leaf_hash(stored | {"text": found}).alias("now"))
    # Written before it is sorted: finding the ranges reads it once more.
    hashes = checkpointed(hashes.withColumn("__tie", F.monotonically_increasing_id()), "leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("__tie").asc()]
    ranged = checkpointed(hashes.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie").withColumn("__row", F.monotonically_increasing_id()), "ranged")
    task = F.shiftright("__row", _LOCAL_BITS)
    spans = checkpointed(ranged.groupBy(task.alias("task"), "source").agg(F.min("__row").alias("first"), F.count("*").alias("number")), "spans")
    # One row per task and source in these windows.
    of_source = Window.partitionBy("source")
    earlier = of_source.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("*", F.coalesce(F.sum("number").over(earlier), F.lit(0)).alias("before"), F.sum("number").over(of_source).alias("total"))
    trees = numbered(spans.select(F.col("source").alias("own")).distinct(), [F.col("own").asc_nulls_first()], "tree")
    spans = spans.join(trees, F.col("source").eqNullSafe(F.col("own"))).select("task", F.col("source").alias("span_source"), "first", "before", "total", "tree")
    same = (task == F.col("task")) & F.col("source").eqNullSafe(F.col("span_source"))
    placed = ranged.join(spans, same).withColumn("place", F.col("__row") - F.col("first") + F.col("before"))
    member = F.struct("place", "doc_id", "leaf", "now")
    grouped = placed.groupBy("tree", "total", F.floor(F.col("place") / FAN).alias("idx")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    return checkpointed(grouped, "runs")


def hashed(kids: Column) -> Column:
    return F.sha2(F.array_join(kids, "").cast("binary"), 256)


def _levels(nodes: DataFrame, level: int, most: int) -> list[DataFrame]:
    """The node rows above ``nodes``, which are all of one level, level by level."""
    found = []
    while -(-most // FAN**level) > 1:
        grouped = nodes.where(_width(F.col("total"), level) > 1).groupBy("tree", "total", F.floor(F.col("idx") / FAN).alias("idx"))
        rows = grouped.agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "hash"))), lambda kid: kid["hash"]).alias("kids"), F.sum("runs").alias("runs"))
        level += 1
        nodes = checkpointed(rows.select("tree", F.lit(level).alias("level"), "idx", "total", hashed(F.col("kids")).alias("hash"), "kids", "runs"), f"level{level}")
        found.append(nodes)
    return found


def nodes_above(runs: DataFrame) -> DataFrame:
    """All node rows with the link to their parent: up_tree, up_level, up_idx, up_place, up_copies (NULL at the root)."""
    single = F.col("total") == 1
    kids = F.transform("members", lambda m: m["leaf"])
    lowest = runs.select(
        "tree", F.when(single, 0).otherwise(1).alias("level"), "idx", "total", F.when(single, kids[0]).otherwise(hashed(kids)).alias("hash"), kids.alias("kids"), F.lit(1).cast("bigint").alias("runs")
    )
    most = runs.agg(F.max("total")).first()[0]
    own = [lowest, *_levels(lowest.where("level = 1"), 1, most)]
    every = own[0].select(*_NODE)
    for rows in own[1:]:
        every = every.union(rows.select(*_NODE))
    trees = checkpointed(every.where(_width(F.col("total"), F.col("level")) == 1).select(F.col("tree").alias("idx"), "hash", "runs"), "subroots")
    number = trees.count()
    subroots = trees.select(F.lit(-1).cast("bigint").alias("tree"), F.lit(0).alias("level"), "idx", F.lit(number).cast("bigint").alias("total"), "hash", "runs")
    for rows in _levels(subroots, 0, number):
        every = every.union(rows.select(*_NODE))
    inside, below = _width(F.col("total"), F.col("level")) > 1, (F.col("tree") >= 0) & F.lit(number > 1)

    def up(within: Column, across: Column) -> Column:
        return F.when(inside, within).when(below, across)

    linked = every.select(
        *_NODE,
        up(F.col("tree"), F.lit(-1)).cast("bigint").alias("up_tree"),
        up(F.col("level") + 1, F.lit(1)).cast("int").alias("up_level"),
        up(F.floor(F.col("idx") / FAN), F.floor(F.col("tree") / FAN)).cast("bigint").alias("up_idx"),
        up(F.col("idx") % FAN, F.col("tree") % FAN).cast("int").alias("up_place"),
    )
    copies = every.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"), F.ceil(F.col("runs") / _PER_COPY).cast("bigint").alias("up_copies"))
    return checkpointed(linked.join(copies, ["up_tree", "up_level", "up_idx"], "left"), "nodes")


def siblings(kids: str, place: str) -> str:
    """SQL for the texts of the children before and after a place."""
    return f"array_join(slice({kids}, 1, {place}), ''), array_join(slice({kids}, {place} + 2, {FAN}), '')"


CLIMB = f"""
    WITH RECURSIVE climb (tree, idx, up_tree, up_level, up_idx, up_place, up_copies, folded, above, subroot, root) AS (
        SELECT tree, idx, up_tree, up_level, up_idx, up_place, up_copies, folded, CAST('' AS STRING), hash, hash FROM {{climbers}}
        UNION ALL
        SELECT c.tree, c.idx, p.up_tree, p.up_level, p.up_idx, p.up_place, p.up_copies,
               transform(c.folded, f -> sha2(concat(array_join(slice(p.kids, 1, c.up_place), ''), f, array_join(slice(p.kids, c.up_place + 2, {FAN}), '')), 256)),
               concat(c.above, {siblings("p.kids", "c.up_place")}),
               if(p.tree >= 0, p.hash, c.subroot), p.hash
        FROM climb c JOIN {{parents}} p
          ON p.tree = c.up_tree AND p.level = c.up_level AND p.idx = c.up_idx AND p.copy = pmod(xxhash64(c.tree, c.idx), c.up_copies)
    )
    SELECT tree, idx, folded, above, subroot, root FROM climb WHERE up_tree IS NULL"""


def climbed(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, idx, folded, above, subroot, root) per run: the root folded from each of its leaves, and the siblings above the run."""
    spark = runs.sparkSession
    now = F.transform("members", lambda m: m["now"])
    start = F.expr(f"transform(members, (m, i) -> sha2(concat(array_join(slice(kids, 1, i), ''), m.now, array_join(slice(kids, i + 2, {FAN}), '')), 256))")
    links = nodes.where("tree >= 0 AND level <= 1").select("tree", "idx", "level", "hash", "kids", "up_tree", "up_level", "up_idx", "up_place", "up_copies")
    climbers = runs.select("tree", "idx", "members").join(links, ["tree", "idx"]).withColumn("folded", F.when(F.col("level") == 0, now).otherwise(start)).drop("members", "kids")
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("runs") / _PER_COPY).cast("bigint") - 1)).alias("copy")
    parents = nodes.where("level >= 1").select("tree", "level", "idx", "hash", "kids", "up_tree", "up_level", "up_idx", "up_place", "up_copies", copy)
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")  # every row climbs; the number of levels ends the query
    try:
        return checkpointed(spark.sql(CLIMB, climbers=checkpointed(climbers, "climbers"), parents=parents), "climbed")
    finally:
        if before is None:
            spark.conf.unset(_ROW_LIMIT)
        else:
            spark.conf.set(_ROW_LIMIT, before)


def check_manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    The manifest is built from ``docs`` as it is; ``found`` is the text as it is found later (as it is, if not given).
    """
    runs = runs_of_leaves(docs, F.col("text") if found is None else found)
    if runs.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    nodes = nodes_above(runs)
    ends = climbed(runs, nodes)
    each = runs.join(ends, ["tree", "idx"]).select(
        F.transform("members", lambda m: m["leaf"]).alias("kids"), "above", "subroot", "root", "folded", F.posexplode("members").alias("at", "member")
    )
    beside = F.expr(f"concat({siblings('kids', '`at`')})")
    return each.select(
        "member.doc_id",
        "member.leaf",
        "subroot",
        "root",
        F.sha2(F.concat(beside, "above").cast("binary"), 256).alias("proof_sha256"),
        F.expr("folded[`at`]").alias("folded_root"),
        (F.expr("folded[`at`]") == F.col("root")).alias("verified"),
    )


def _field_sql(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join([*(_field_sql(name) for name in FIELDS[:-1]), _field_sql(text)]) + ")"


def manifest_sql() -> str:
    """``check_manifest`` with ``tampered`` texts, in DuckDB's SQL: levels and climb by recursion, places by windows."""
    return f"""
        WITH RECURSIVE crc_table AS (
            SELECT list(v ORDER BY b) AS t FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) AS r(b))),
        chosen AS (
            SELECT d.*, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                                            lambda crc, c: xor(crc >> 8, t[CAST(xor(crc, c) & 255 AS INTEGER) + 1])), 4294967295) % 5 = 0, false) AS struck
            FROM documents d, crc_table),
        found AS (
            SELECT *, CASE WHEN struck THEN translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') ELSE text END AS now FROM chosen),
        leaves AS (
            SELECT doc_id, {_leaf_sql("text")} AS leaf, {_leaf_sql("now")} AS now,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, source, count(*) OVER (PARTITION BY source) AS total
            FROM found),
        placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
        inner_nodes AS (
            SELECT tree, 0 AS level, place AS idx, total AS width, leaf AS hash FROM placed
            UNION ALL
            SELECT tree, level + 1, idx // {FAN}, (width + {FAN - 1}) // {FAN}, sha256(string_agg(hash, '' ORDER BY idx))
            FROM inner_nodes WHERE width > 1 GROUP BY tree, level, idx // {FAN}, width),
        subroots AS (SELECT tree, hash, level FROM inner_nodes WHERE width = 1),
        top_nodes AS (
            SELECT 0 AS level, tree AS idx, (SELECT count(*) FROM subroots) AS width, hash FROM subroots
            UNION ALL
            SELECT level + 1, idx // {FAN}, (width + {FAN - 1}) // {FAN}, sha256(string_agg(hash, '' ORDER BY idx))
            FROM top_nodes WHERE width > 1 GROUP BY level, idx // {FAN}, width),
        whole AS (SELECT hash AS root FROM top_nodes WHERE width = 1),
        steps AS (
            SELECT tree, level, idx // {FAN} AS up, list(hash ORDER BY idx) AS kids FROM inner_nodes WHERE width > 1 GROUP BY ALL
            UNION ALL
            SELECT -1, level, idx // {FAN}, list(hash ORDER BY idx) FROM top_nodes WHERE width > 1 GROUP BY ALL),
        climb AS (
            SELECT doc_id, leaf, tree AS own, place AS own_place, tree, 0 AS level, place AS idx, total AS width, now AS folded, '' AS proof FROM placed
            UNION ALL
            SELECT c.doc_id, c.leaf, c.own, c.own_place,
                   CASE WHEN c.width > 1 THEN c.tree ELSE -1 END, CASE WHEN c.width > 1 THEN c.level + 1 ELSE 0 END,
                   CASE WHEN c.width > 1 THEN c.idx // {FAN} ELSE c.tree END,
                   CASE WHEN c.width > 1 THEN (c.width + {FAN - 1}) // {FAN} ELSE (SELECT count(*) FROM subroots) END,
                   CASE WHEN c.width > 1 THEN sha256(array_to_string(kids[1:c.idx % {FAN}], '') || folded || array_to_string(kids[c.idx % {FAN} + 2:], '')) ELSE folded END,
                   CASE WHEN c.width > 1 THEN proof || array_to_string(kids[1:c.idx % {FAN}], '') || array_to_string(kids[c.idx % {FAN} + 2:], '') ELSE proof END
            FROM climb c LEFT JOIN steps s ON s.tree = c.tree AND s.level = c.level AND s.up = c.idx // {FAN}
            WHERE c.width > 1 OR c.tree >= 0)
        SELECT c.doc_id, c.leaf, s.hash AS subroot, w.root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = w.root AS verified
        FROM climb c JOIN subroots s ON s.tree = c.own, whole w WHERE c.tree = -1 AND c.width = 1"""
