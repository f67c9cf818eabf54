"""Jaccard join of texts on word shingles: a MinHash LSH forest finds candidates, the shingle sets decide.

In each of several trees a document's label is a sequence of min-hashes. Labels are stored whole; sorted, a tree's labels are
a prefix trie, whose nodes are the runs of labels with a common prefix. A join at a threshold can't stop while a pair just at
it may still lie apart, so all documents are read at the depth where such a pair shares a node with probability ``RECALL``.
From there on prefixes get shorter document by document: the verified links of a document, each weighed by how likely a pair of
its similarity meets at that depth, say how many links it has beside the ones found, and where they say that less than
``DOCUMENT_RECALL`` of them was found, the document is read a level higher, among all members of its nodes there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace
from txguard.llm import textarrays as ta
from txguard.llm.blocks import block_pairs
from txguard.llm.links import named_links

WORDS = 5
SIMILARITY = 0.8
TREES, LABEL = 14, 8
RECALL = 0.999  # of a pair just at the threshold, at the depth that all documents are read at
DOCUMENT_RECALL = 0.99995  # of a document's links, as its verified ones let expect; below it its prefixes are shortened
AGREE = 0.5  # share of equal min-hashes from which a pair is verified; a pair at 0.8 falls below it once in 10^11 times
BLOCK = 400_000  # shingles of a block
NODE_ROWS, MOST_TASKS = 4_000, 20_000  # members of nodes that a task takes, unless there would be more tasks than that
BROADCAST_ROWS = 500_000  # so many ids and keys of candidates are broadcast to the texts; more meet them in a shuffle
SEED = 7
GROUP = ["tree", "bucket", "low", "high"]


def meeting(similarity, depth: int, trees: int = TREES):
    """The probability that a pair of that similarity shares a prefix of that length in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def match_depth(similarity: float = SIMILARITY, trees: int = TREES, label: int = LABEL, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of that similarity meets in some tree with probability ``recall``; 1 at least."""
    depth = label
    while depth > 1 and meeting(similarity, depth, trees) < recall:
        depth -= 1
    return depth


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's word shingles; fewer words than ``size``, but some, are one shingle."""
    words, _, _, bounds = ta.tokens(data, offsets)
    found, ends = ta.runs(words, bounds, size, whole=True)
    return [np.unique(found[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def labels(sets: list[np.ndarray]) -> np.ndarray:
    """The label of each document in each tree: ``LABEL`` min-hashes. Sets are not empty."""
    random = np.random.default_rng(SEED)
    factors = random.integers(1, 1 << 63, (TREES, LABEL), np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 1 << 63, (TREES, LABEL), np.uint64)
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((len(sets), TREES, LABEL), ">u4")  # in this order of bytes labels sort as their min-hashes do
    for tree in range(TREES):
        for level in range(LABEL):
            least = np.minimum.reduceat((every ^ shifts[tree, level]) * factors[tree, level], starts)
            out[:, tree, level] = ta.mix(least) >> np.uint64(32)
    return out


def _signatures(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in ta.chunks(batch.column("text")):
                sets = shingles(data, offsets)
                some = [i for i, s in enumerate(sets) if len(s)]
                label: list = [None] * len(sets)
                if some:
                    for i, row in zip(some, labels([sets[i] for i in some])):
                        label[i] = row.tobytes()
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).slice(a, b - a) for n in names] + [
                        pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(label, pa.binary())], names=[*names, "key", "n", "label"])

    return run


def _nodes(depth: int):
    """For each tree the node of a row's label at that depth."""
    return F.array(*[F.xxhash64(F.lit(t), F.substring("label", 4 * LABEL * t + 1, 4 * depth)) for t in range(TREES)])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in ta.chunks(batch.column("text")):
            sets = shingles(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(a, b - a), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "set"])


def prefixes(label: np.ndarray, depth: int) -> np.ndarray:
    """A number for the prefix of each row's label in each tree."""
    out = np.zeros(label.shape[:2], np.uint64)
    for level in range(depth):
        out = ta.mix(out * ta.RADIX + label[:, :, level].astype(np.uint64) + np.uint64(1))
    return out


class _Nodes:
    """Whole nodes of a stream, their members in the order of their labels, and who is compared with whom there."""

    def __init__(self, frame: pd.DataFrame, bounds: np.ndarray, depth: int, floor: int):
        label = np.frombuffer(b"".join(frame["label"]), ">u4").reshape(len(frame), TREES, LABEL).astype(np.uint32)
        self.frame, self.bounds = frame, bounds
        self.met = prefixes(label, depth)
        self.before = prefixes(label, depth + 1) if depth < floor else None
        self.label = label.reshape(len(frame), -1)
        self.tree, self.sizes, self.short = (frame[c].to_numpy() for c in ("tree", "n", "short"))
        self.block, self.cut = frame["block"].to_numpy(), (frame["low"] != frame["high"]).to_numpy()

    def each(self) -> Iterator[tuple[int, int]]:
        """First and end row of each node with more than one member."""
        return ((a, b) for a, b in zip(self.bounds[:-1], self.bounds[1:]) if b - a > 1)

    def partners(self, a: int, i: int) -> np.ndarray:
        """Rows from ``a`` on and before ``i`` that meet ``i`` here first, agree in enough min-hashes, and have a fitting size."""
        sizes, tree = self.sizes[a:i], self.tree[i]
        fits = np.minimum(sizes, self.sizes[i]) >= SIMILARITY * np.maximum(sizes, self.sizes[i]) - 1e-9
        fits &= self.met[a:i, tree] == self.met[i, tree]
        if self.cut[i]:
            fits &= self.block[a:i] != self.block[i]
        if not self.short[i]:
            fits &= self.short[a:i]
        if tree:
            fits &= ~(self.met[a:i, :tree] == self.met[i, :tree]).any(axis=1)
        if self.before is not None and fits.any():
            fits &= ~(self.before[a:i] == self.before[i]).any(axis=1)
        at = a + np.flatnonzero(fits)
        if len(at):
            at = at[(self.label[at] == self.label[i]).sum(axis=1) >= AGREE * TREES * LABEL]
        return at


def _nodes_of(frames: Iterator[pd.DataFrame], depth: int, floor: int) -> Iterator[_Nodes]:
    """The nodes of a sorted stream, as many at once as a frame holds; one that is not complete waits for the next frame."""
    held = None
    for frame in frames:
        if not len(frame):
            continue
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        new = np.zeros(len(frame) - 1, bool)
        for name in GROUP:
            values = frame[name].to_numpy()
            new |= values[1:] != values[:-1]
        starts = np.append(0, np.flatnonzero(new) + 1)
        held = frame.iloc[starts[-1]:].reset_index(drop=True)
        if len(starts) > 1:
            yield _Nodes(frame.iloc[:starts[-1]], starts, depth, floor)
    if held is not None:
        yield _Nodes(held, np.array([0, len(held)]), depth, floor)


def _useful(depth: int, floor: int):
    """The members of each node that have somebody to be verified with there."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nodes in _nodes_of(frames, depth, floor):
            useful = np.zeros(len(nodes.frame), bool)
            for a, b in nodes.each():
                for i in range(a + 1, b):
                    at = nodes.partners(a, i)
                    if len(at):
                        useful[i] = True
                        useful[at] = True
            yield nodes.frame.loc[useful, [*GROUP, "block", "short", "key"]]

    return run


def _links(depth: int, floor: int):
    """Verified links of each node: for each key how many documents it links with, and edges that span its links.

    A pair counts in the first tree whose prefix it shares at the first depth that it is read at, so it counts once however
    often it meets. ``seen`` counts the linked classes; ``missed`` has for each depth from 1 how many more classes these let expect that
    no tree brings together at that depth.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for nodes in _nodes_of(frames, depth, floor):
            every, keys, copies = nodes.frame["set"].to_numpy(), nodes.frame["key"].to_numpy(), nodes.frame["copies"].to_numpy()
            links, seen = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            root, missed = np.arange(len(keys)), np.zeros((len(keys), floor))
            for a, b in nodes.each():
                sets = [np.frombuffer(s, np.uint64) for s in every[a:b]]
                sizes = np.array([len(s) for s in sets])
                _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                mark = np.zeros(int(inverse.max()) + 1, np.int8)
                for i in range(1, b - a):
                    at = nodes.partners(a, a + i) - a
                    if not len(at):
                        continue
                    mine = inverse[starts[i]:starts[i + 1]]
                    mark[mine] = 1
                    common = np.add.reduceat(mark[inverse[:starts[i]]].astype(np.int32), starts[:i])[at]
                    mark[mine] = 0
                    either = sizes[at] + sizes[i] - common
                    near = common >= SIMILARITY * either - 1e-9
                    at, alike = a + at[near], (common / either)[near]
                    if len(at):
                        links[a + i] += copies[at].sum()
                        links[at] += copies[a + i]
                        seen[a + i] += len(at)
                        seen[at] += 1
                        more = np.stack([1 / meeting(alike, d) - 1 for d in range(1, floor + 1)], axis=1)
                        missed[a + i] += more.sum(axis=0)
                        missed[at] += more
                        old = np.unique(np.append(root[at], root[a + i]))
                        if len(old) > 1:
                            own = root[a:b]
                            own[np.isin(own, old)] = old[0]
            some = np.flatnonzero(links)
            if len(some):
                yield pd.DataFrame({"key": keys[some], "links": links[some], "near": keys[root[some]],
                                    "seen": seen[some], "missed": list(missed[some])})

    return run


def short_of_links(found: DataFrame, depth: int) -> DataFrame:
    """``key`` of the classes of which reading at ``depth`` has found less than ``DOCUMENT_RECALL`` of their links."""
    return found.groupBy("key").agg(
        F.sum("seen").alias("seen"), F.sum(F.element_at("missed", depth)).alias("missed")
    ).where(F.col("missed") > (1 - DOCUMENT_RECALL) * (F.col("seen") + F.col("missed"))).select("key")


def _tasks(rows: int) -> int:
    return min(MOST_TASKS, rows // NODE_ROWS + 1)


def _read(given: DataFrame, classes: DataFrame, depth: int, floor: int, short: DataFrame | None) -> DataFrame:
    """Verified links of the nodes at one depth: of all members, or with ``short`` (keys) of pairs with one of those."""
    spark = given.sparkSession
    if short is None:
        classes = classes.withColumn("short", F.lit(True))
    else:
        classes = classes.join(short.withColumn("short", F.lit(True)), "key", "left").withColumn(
            "short", F.coalesce("short", F.lit(False)))
    places = classes.select("key", "n", "short", F.posexplode(_nodes(depth)).alias("tree", "bucket"))
    # A member weighs its shingles and its label, in numbers of eight bytes.
    shared = places.groupBy("bucket").agg(
        F.count("*").alias("members"), F.sum(F.col("n") + TREES * LABEL // 2).alias("weight"), F.max("short").alias("read")
    ).where("members > 1 AND read")
    shared = workspace.write_table(shared, workspace.new_path(spark, "shared"))
    rows = shared.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    members = places.select("key", "tree", "bucket").join(shared, "bucket", "left_semi")
    narrow = block_pairs(members, shared, "bucket", "key", BLOCK).join(classes.select("key", "n", "label", "short"), "key")
    useful = workspace.write_table(
        narrow.repartition(_tasks(rows), *GROUP).sortWithinPartitions(*GROUP, "label").mapInPandas(
            _useful(depth, floor), "tree int, bucket long, low int, high int, block int, short boolean, key binary"),
        workspace.new_path(spark, "useful"))

    # Only texts that are verified with another one are read again, one text for each set.
    wanted = classes.join(useful.select("key").distinct(), "key", "left_semi").select(
        "key", F.col("one.doc_id").alias("one_id"), F.col("one.text_key").alias("one_key"))
    wanted = workspace.write_table(wanted, workspace.new_path(spark, "wanted"))
    small = wanted.count() <= BROADCAST_ROWS
    texts = given.join(F.broadcast(wanted) if small else wanted, (
        F.col("text_key") == F.col("one_key")) & F.col("doc_id").eqNullSafe(F.col("one_id"))).select("key", "text")
    sets = texts.mapInArrow(_sets, "key binary, set binary")
    full = classes.select("key", "n", "copies", "label").join(sets, "key")
    found = (
        useful.join(full, "key").repartition(_tasks(4 * useful.count()), *GROUP).sortWithinPartitions(*GROUP, "label")
        .mapInPandas(_links(depth, floor), "key binary, links long, near binary, seen long, missed array<double>")
    )
    return workspace.write_table(found, workspace.new_path(spark, "links"))


def _all_links(given: DataFrame, classes: DataFrame) -> DataFrame:
    """Verified links of all classes, with prefixes shortened class by class."""
    spark = given.sparkSession
    floor = match_depth()
    found = _read(given, classes, floor, floor, None)
    short = None
    for depth in range(floor - 1, 0, -1):
        weak = short_of_links(found, depth + 1)
        if short is not None:
            weak = weak.join(short, "key", "left_semi")
        short = workspace.write_table(weak, workspace.new_path(spark, "short"))
        if short.isEmpty():
            break
        found = found.unionByName(_read(given, classes, depth, floor, short))
    return found


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_key`` (MD5 of the text), ``copy_id``, ``n_links``, ``class_id``, ``kept``.

    Documents with equal shingle sets are copies (``copy_id``: their smallest id), compared once; every copy counts as a
    link. ``class_id`` is the smallest id of all documents reachable by links, ``kept`` marks that document. A text
    without words (null, empty) links with nothing. Rows without an id take part and are named by the others; repeated rows
    are copies of each other. An empty table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    text_key = F.md5(F.encode(text, "UTF-8"))
    given = docs.select(F.col(doc).alias("doc_id"), text_key.alias("text_key"), F.col(text).alias("text"))
    kind = dict(given.dtypes)["doc_id"]
    stored = workspace.write_table(
        given.mapInArrow(_signatures(["doc_id", "text_key"]),
                         f"doc_id {kind}, text_key string, key binary, n long, label binary"),
        workspace.new_path(spark, "signatures"))
    classes = workspace.write_table(
        stored.where("key IS NOT NULL").groupBy("key").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.any_value("n").alias("n"),
            F.any_value("label").alias("label"), F.min(F.struct("doc_id", "text_key")).alias("one")),
        workspace.new_path(spark, "classes"))
    found = _all_links(given, classes)
    return named_links(stored, classes, found, "doc_id", "text_key").select(
        "doc_id", "text_key", F.coalesce("first", "doc_id").alias("copy_id"), "n_links",
        F.col("component_id").alias("class_id"), "kept")


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest id; all columns stay.

    Texts without words are in no group and all stay. Of repeated rows (equal id and text) one stays; of a group whose
    rows all lack an id, that with the smallest text key.
    """
    spark = docs.sparkSession
    found = workspace.write_table(near_duplicates(docs, doc, text), workspace.new_path(spark, "near"))
    grouped = found.where("n_links > 0")
    by_class = F.coalesce(F.col("class_id").cast("string"), F.col("text_key"))
    chosen = grouped.groupBy(by_class.alias("class")).agg(
        F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one"))
    chosen = chosen.select(F.col("one.doc_id").alias("__id"), F.col("one.text_key").alias("__key"))
    rows = grouped.groupBy("doc_id", "text_key").agg(F.count("*").alias("__n")).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__n")
    # Rows to settle: all of the groups, each with what becomes of it. All other rows pass.
    same = F.col("c.__id").eqNullSafe(F.col("r.__id")) & (F.col("c.__key") == F.col("r.__key"))
    verdict = rows.alias("r").join(chosen.withColumn("__chosen", F.lit(True)).alias("c"), same, "left").select(
        F.col("r.__id").alias("__id"), F.col("r.__key").alias("__key"), "__n", "__chosen")
    verdict = workspace.write_table(verdict, workspace.new_path(spark, "verdict"))
    key = F.md5(F.encode(docs[text], "UTF-8"))
    gone = verdict.where("__chosen IS NULL OR __n > 1").select("__id", "__key")
    # Ids and keys of 32 characters: broadcast up to a bound, so that no text moves; beyond it both sides are shuffled.
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    passed = docs.join(gone, docs[doc].eqNullSafe(gone["__id"]) & (key == gone["__key"]), "left_anti")
    repeated = verdict.where("__chosen AND __n > 1").select("__id", "__key")
    some = repeated.limit(BROADCAST_ROWS + 1).count()
    if not some:
        return passed
    if some <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    one = docs.join(repeated, docs[doc].eqNullSafe(repeated["__id"]) & (key == repeated["__key"]), "left_semi")
    return passed.unionByName(one.dropDuplicates([doc, text]))
