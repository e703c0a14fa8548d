"""Near duplicates by min-max hashing, with links confirmed on the full shingle sets.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum: half as many hash evaluations as for minima
alone, each value still agrees with probability equal to the Jaccard similarity, and the two vary against each other, which lowers the
variance of their mean. Signatures are cut into bands; documents that share a band are candidates. With 50 bands of 6 values a pair at
similarity 0.75 is missed with probability 6e-5, at 0.8 with 3e-7; for unions of only 4 shingles it is about 9e-4 at 0.75 (17 of 19,352 simulated).

Documents with equal shingle sets are one class and go on as one representative, the smallest id, so groups of copies cost nothing further.
Candidates are tested in rounds. In a star round every document that shares a band with another component is tested against one
centre there: at most one pair a document, however large the band. Links merge components, and whatever lies in one component needs no further tests.
The last rounds test every pair left that shares a band across two components, so that the result is that of testing all candidates:
documents without a partner whose signature agrees well enough (4.5 standard deviations, a chance of about 3e-6 at the threshold if values were independent;
``deviations=None`` tests them all) drop out. The others of a band are dealt into blocks of bounded size. First the rows inside each block are compared, then blocks with each other inside spans of ``SPAN``
blocks, then such spans inside wider ones, as in a tournament. Links merge components after each round, so a round only looks at blocks that still hold several components, and a component hands on one link, not one for
every block it meets. Centres, labels and links are tables in the shared folder.

Defined results: words are runs of other characters than ASCII white space, with A-Z in lower case. Fewer than five words are
one shingle; NULL, empty and blank text have none and link with nothing. Rows that repeat an id with different texts are linked each by its own text;
a component's id is the smallest id of its rows. Rows with a NULL id are linked with nothing and have no component. Extra columns are ignored by ``near_duplicates``. ``drop_near_copies``
keeps all columns, one row of each component, and every row that is linked with nothing for want of an id or of words. Empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.shared import PRIME, WordHashes, arrow_schema, checkpointed, lower_ascii, map_columns, mixed

SHINGLE, BANDS, BAND_VALUES, STAR_ROUNDS, CELL_ROWS, SPAN = 5, 50, 6, 2, 256, 16
PERCENT = 75


def shingles(text: bytes, hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text whose letters are lowered."""
    words = text.split()
    if not words:
        return np.zeros(0, "uint64")
    ids = np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))
    span = min(width, len(ids))
    out = np.full(len(ids) - span + 1, span, "uint64")
    for i in range(span):
        out = out * PRIME + ids[i : len(ids) - span + 1 + i]
    return np.unique(mixed(out))


class MinMax:
    """Bands of a min-max signature."""

    def __init__(self, bands: int = BANDS, values: int = BAND_VALUES, seed: int = 5):
        if bands * values % 2:
            raise ValueError("every permutation gives two values")
        random = np.random.default_rng(seed)
        number = bands * values // 2
        self.factors = random.integers(0, 2**31, number, dtype="uint32") * np.uint32(2) + np.uint32(1)
        self.shifts = random.integers(0, 2**32, number, dtype="uint32")
        self.bands, self.values = bands, values

    def signature(self, found: np.ndarray) -> np.ndarray:
        """Minimum and maximum of each permutation, side by side."""
        short = (found >> np.uint64(32)).astype("uint32")
        low, high = np.full(len(self.factors), 2**32 - 1, "uint32"), np.zeros(len(self.factors), "uint32")
        for at in range(0, len(short), 512):
            permuted = short[at : at + 512, None] * self.factors
            permuted += self.shifts
            np.minimum(low, permuted.min(0), out=low)
            np.maximum(high, permuted.max(0), out=high)
        return np.stack([low, high], 1).ravel()

    def keys(self, signature: np.ndarray) -> list[int]:
        """One 64-bit key per band."""
        rows = signature.astype("uint64").reshape(self.bands, self.values)
        key = np.arange(1, self.bands + 1, dtype="uint64")
        for i in range(self.values):
            key = mixed(key * PRIME + rows[:, i])
        return key.view("int64").tolist()


def low_bits(signature: np.ndarray) -> list[int]:
    """Two bits of a hash of every value and its place, 32 values a number.

    Not bits of the value: a permutation is an odd multiple, so two shingles that agree in their low bits would do so in all permutations.
    """
    places = np.arange(len(signature), dtype="uint64") << np.uint64(32)
    padded = np.zeros(-(-len(signature) // 32) * 32, "uint64")
    padded[: len(signature)] = mixed(mixed(signature.astype("uint64") | places)) & np.uint64(3)
    shifts = np.arange(0, 64, 2, dtype="uint64")
    return (padded.reshape(-1, 32) << shifts).sum(1, dtype="uint64").view("int64").tolist()


def most_disagreements(values: int, percent: int, deviations: float = 4.5) -> int:
    """In how many of ``values`` two-bit places a pair at the threshold may disagree."""
    similarity = percent / 100
    agree = similarity + (1 - similarity) / 4
    return int(values * (1 - agree) + deviations * (values * agree * (1 - agree)) ** 0.5)


def disagreements(mine: Column, theirs: Column, numbers: int) -> Column:
    """Number of two-bit places in which two arrays of ``low_bits`` differ."""
    pairs = F.lit(0x5555555555555555)
    found = [mine[i].bitwiseXOR(theirs[i]) for i in range(numbers)]
    return reduce(Column.__add__, (F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(pairs)) for x in found))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): lowered bytes of the text, and a hash that tells the texts of one id apart."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lower_ascii(F.col("text")).cast("binary").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def sketches(docs: DataFrame, width: int = SHINGLE, bands: int = BANDS, values: int = BAND_VALUES) -> DataFrame:
    """(doc_id, text_key, n_shingles, digest, bands, sketch) of every row; ``digest`` stands for the whole set."""

    def work(ids, keys, texts):
        hashes, signer = WordHashes(), MinMax(bands, values)
        out = {"doc_id": ids, "text_key": keys, "n_shingles": [], "digest": [], "bands": [], "sketch": []}
        last: dict[bytes, tuple[list[int], list[int]]] = {}
        for text in texts:
            found = shingles(text, hashes, width)
            digest = xxhash.xxh3_128_digest(found.tobytes())
            if digest not in last:
                signature = signer.signature(found)
                last[digest] = (signer.keys(signature), low_bits(signature)) if len(found) else ([], [])
            out["n_shingles"].append(len(found))
            out["digest"].append(digest)
            out["bands"].append(last[digest][0])
            out["sketch"].append(last[digest][1])
        return out

    return map_columns(keyed(docs), "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>", work)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets have an intersection of ``percent`` of their union, or more."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # b first: it rarely repeats. Pairs of a frequent centre a meet its text in the second join, which streams it.
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    target = arrow_schema(pairs.sparkSession, "a bigint, b bigint")

    def run(batches):
        hashes, held, mine = WordHashes(), None, None
        for batch in batches:
            kept = []
            a_ids, b_ids, b_texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for i, (a, b) in enumerate(zip(a_ids, b_ids, strict=True)):
                if a != held:
                    held, mine = a, shingles(batch.column(2)[i].as_py(), hashes, width)
                theirs = shingles(b_texts[i].as_py(), hashes, width)
                if 100 * min(len(mine), len(theirs)) < percent * max(len(mine), len(theirs)):
                    continue
                common = len(np.intersect1d(mine, theirs, assume_unique=True))
                if 100 * common >= percent * (len(mine) + len(theirs) - common):
                    kept.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in kept], pa.int64()), pa.array([b for _, b in kept], pa.int64())], schema=target)

    return both.mapInArrow(run, "a bigint, b bigint")


def cell_links(rows: list[tuple[int, int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links (a, b) between the two blocks of a cell, or within its only block, enough to connect all labels that are linked.

    Rows are (block, node, label, set). One row's common shingles with all others are counted in one pass over their sets.
    """
    first, last = min(r[0] for r in rows), max(r[0] for r in rows)
    sides = [r for r in rows if r[0] == first], [r for r in rows if r[0] == last]
    top: dict[int, int] = {}

    def find(label: int) -> int:
        while top.get(label, label) != label:
            label = top[label]
        return label

    values, places = np.unique(np.concatenate([r[3] for r in sides[1]]), return_inverse=True)
    sizes = np.array([len(r[3]) for r in sides[1]])
    edges = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    labels, held, links = np.array([r[2] for r in sides[1]]), np.zeros(len(values), "int32"), []
    for _, node, label, own in sides[0]:
        at = np.minimum(np.searchsorted(values, own), len(values) - 1)
        at = at[values[at] == own]
        held[at] = 1
        common = np.add.reduceat(held[places], edges)
        held[at] = 0
        for i in np.flatnonzero((100 * common >= percent * (sizes + len(own) - common)) & (labels != label)).tolist():
            x, y = find(label), find(int(labels[i]))
            if x != y:
                top[max(x, y)] = min(x, y)
                links.append((node, sides[1][i][1]))
    return links


def active_rows(split: DataFrame, percent: int, values: int, deviations: float | None) -> DataFrame:
    """The (key, node) of ``split``, rows (key, node, label, sketch), with a partner of another label whose sketch agrees well enough."""
    if deviations is None:
        return split.select("key", "node")
    numbers, most = -(-values // 32), most_disagreements(values, percent, deviations)
    other = split.select(F.col("key").alias("same"), F.col("label").alias("other"), F.col("sketch").alias("others"))
    near = disagreements(F.col("sketch"), F.col("others"), numbers) <= most
    return split.join(other, (F.col("key") == F.col("same")) & (F.col("label") != F.col("other")) & near, "left_semi").select("key", "node")


def links_in_cells(cells: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) between labels, each once, found inside each cell (key, i, j) of rows (own, node, label, text)."""
    target = arrow_schema(cells.sparkSession, "a bigint, b bigint")

    def found(held, hashes):
        if len({label for _, _, label, _ in held}) < 2:
            return []
        label_of = {node: label for _, node, label, _ in held}
        pairs = cell_links([(own, node, label, shingles(text, hashes, width)) for own, node, label, text in held], percent)
        return [(min(label_of[a], label_of[b]), max(label_of[a], label_of[b])) for a, b in pairs]

    def run(batches):
        hashes, cell, held = WordHashes(), None, []
        for batch in batches:
            links = []
            for *place, own, node, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != cell:
                    links += found(held, hashes)
                    cell, held = place, []
                held.append((own, node, label, text))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], schema=target)
        links = found(held, hashes)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], schema=target)

    return cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a bigint, b bigint").distinct()


def cells_of_round(placed: DataFrame, labels: DataFrame, unit: int) -> DataFrame:
    """Rows (key, i, j, own, node, label) of the cells of a round: single blocks (``unit`` 0), or the pairs of blocks of different units among ``SPAN`` units.

    Blocks, or spans of units, that hold one label only are left out.
    """
    group = F.floor(F.col("own") / (unit * SPAN or 1))
    rows = placed.join(labels, "node").withColumn("group", group)
    several = rows.groupBy("key", "group").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key", "group")
    rows = rows.join(several, ["key", "group"])
    if not unit:
        return rows.select("key", F.col("own").alias("i"), F.col("own").alias("j"), "own", "node", "label")
    first = (F.col("group") * unit * SPAN).cast("int")
    blocks = F.sequence(first, F.least(first + unit * SPAN, F.col("blocks")) - 1)
    rows = rows.withColumn("across", F.explode(F.filter(blocks, lambda x: F.floor(x / unit) != F.floor(F.col("own") / unit))))
    return rows.select("key", F.least("own", "across").alias("i"), F.greatest("own", "across").alias("j"), "own", "node", "label")


def tournament(active: DataFrame, labels: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """``labels`` after all links among the rows (key, node) of each band, between different labels, are merged."""
    sizes = active.groupBy("key").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("blocks"))
    placed = checkpointed(active.join(sizes, "key").select("key", "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")), "placed")
    most, unit = placed.agg(F.max("blocks")).first()[0] or 0, 0
    while unit < most:
        cells = cells_of_round(placed, labels, unit).join(texts, "node").select("key", "i", "j", "own", "node", "label", "text")
        links = checkpointed(links_in_cells(cells, percent, width), "links")
        if not links.isEmpty():
            labels = checkpointed(merged(labels, links), "labels")
        unit = unit * SPAN or 1
    return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after components that ``links`` (a, b) connect take their smallest label.

    Minima travel along the links between components, and each step also takes over the label of one's label, so the number of steps
    grows with the logarithm of the longest chain. Each step is written.
    """
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("u")), "a").join(labels.select(F.col("node").alias("b"), F.col("label").alias("v")), "b")
    ends = ends.where("u <> v").select("u", "v").distinct()
    arcs = checkpointed(ends.union(ends.select(F.col("v"), F.col("u"))).distinct(), "arcs")
    roots = checkpointed(arcs.select(F.col("u").alias("root")).distinct().select("root", F.col("root").alias("top")), "roots")
    moved = roots.count()
    while moved:
        offers = arcs.join(roots.select(F.col("root").alias("v"), "top"), "v").groupBy(F.col("u").alias("root")).agg(F.min("top").alias("offer"))
        lower = roots.join(offers, "root").select("root", F.col("top").alias("was"), F.least("top", "offer").alias("top"))
        jump = lower.join(roots.select(F.col("root").alias("top"), F.col("top").alias("further")), "top").select("root", "was", F.least("top", "further").alias("top"))
        step = checkpointed(jump, "roots")
        moved = step.where("top < was").count()
        roots = step.select("root", "top")
    return labels.join(roots.withColumnRenamed("root", "label"), "label", "left").select("node", F.coalesce("top", "label").alias("label"))


def _apart(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (key, node, label, least, centre) of bands that hold more than one component; the centre has the label ``least``."""
    labelled = checkpointed(shared.join(labels, "node"), "labelled")
    ends = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").drop("most")
    split = labelled.join(ends, "key")
    centres = split.where("label = least").groupBy("key").agg(F.min("node").alias("centre"))
    return split.join(centres, "key")


def components(docs: DataFrame, found: DataFrame, percent: int, width: int, values: int, star_rounds: int, deviations: float | None) -> DataFrame:
    """Classes of equal sets as (digest, node, component, component_id): ``node`` is one row's number, ``component`` one node's for all that are linked."""
    usable = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = checkpointed(usable.groupBy("digest").agg(F.min("doc_id").alias("least"), F.min("row").alias("node")), "classes")
    first = found.withColumnRenamed("row", "node").join(classes.select("node"), "node")
    own = first.select("node", F.explode("bands").alias("key"))
    crowded = own.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    shared = checkpointed(own.join(crowded, "key").select("key", "node"), "shared")
    involved = shared.select("node").distinct()
    labels = checkpointed(involved.select("node", F.col("node").alias("label")), "labels")
    wanted = first.select("node", "doc_id", "text_key").join(labels.select("node"), "node")
    texts = checkpointed(keyed(docs).join(wanted, ["doc_id", "text_key"]).select("node", "text").dropDuplicates(["node"]), "texts")
    tested = None
    for _ in range(star_rounds):
        pairs = _apart(shared, labels).where("label <> least").groupBy(F.col("node").alias("b")).agg(F.min("centre").alias("a")).select("a", "b")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = checkpointed(pairs, "pairs")
        links = checkpointed(confirmed(pairs, texts, percent, width), "links")
        tested = pairs if tested is None else tested.union(pairs)
        labels = checkpointed(merged(labels, links), "labels")
    split = _apart(shared, labels)
    marks = first.join(split.select("node").distinct(), "node").select("node", "sketch")
    split = checkpointed(split.select("key", "node", "label").join(marks, "node"), "split")
    active = checkpointed(active_rows(split, percent, values, deviations), "active")
    labels = tournament(active, labels, texts, percent, width)
    least = labels.join(classes, "node").groupBy("label").agg(F.min("least").alias("component_id"))
    named = labels.join(least, "label").select("node", F.col("label").alias("component"), "component_id")
    return classes.join(named, "node", "left").select("digest", "node", F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "least").alias("component_id"))


def judged(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, bands: int = BANDS, values: int = BAND_VALUES, star_rounds: int = STAR_ROUNDS, deviations: float | None = 4.5) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id, kept) for every row of ``docs``."""
    found = checkpointed(sketches(docs, width, bands, values).withColumn("row", F.monotonically_increasing_id()), "sketches")
    classes = components(docs, found, percent, width, bands * values, star_rounds, deviations).drop("node")
    every = "doc_id", "text_key", "n_shingles", "component", "component_id"
    linked = found.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "text_key", "n_shingles", "digest").join(classes, "digest").select(*every)
    alone = found.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "text_key", "n_shingles", F.lit(None).cast("bigint").alias("component"), F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; the parameters are those of ``judged``."""
    return judged(docs, **parameters).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_copies(docs: DataFrame, **parameters) -> DataFrame:
    """One row of each component of ``docs``, of those with its smallest id, and all rows without an id or words; all columns unchanged."""
    kept = judged(docs, **parameters).where("kept AND component IS NOT NULL").select(F.col("doc_id").alias("__kept"), F.col("text_key").alias("__text"), "component").distinct()
    kept = kept.withColumnRenamed("component", "__component")
    columns = [f"`{c}`" for c in docs.columns]
    orderable = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    repeated = Window.partitionBy("__component").orderBy(*orderable)
    same = (F.col("doc_id").cast("bigint") == F.col("__kept")) & (F.xxhash64(lower_ascii(F.col("text")).cast("binary")) == F.col("__text"))
    found = docs.join(kept, same).withColumn("__n", F.row_number().over(repeated)).where("__n = 1")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return found.select(*columns).union(docs.where(F.col("doc_id").isNull() | ~has_words).select(*columns))
