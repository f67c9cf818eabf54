"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by fast Hadamard rotations with random signs, and hashed to the nearest corner of the cross-polytope,
that is to its largest coordinate and sign. A bucket of a table is a tuple of such corners; a vector goes to the several
most likely buckets of each table. Vectors that share a bucket are compared exactly.
"""

from __future__ import annotations

import hashlib
import itertools
import math
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

COSINE = 0.9
RECALL = 0.9995  # wanted share of the pairs exactly at the cosine that share a bucket
PROBES = 8
# By padded size: rotations, and the measured share of pairs at the cosine that meet in one table.
MEET = {64: (4, 0.478), 128: (4, 0.368), 256: (3, 0.564), 512: (3, 0.496), 1024: (3, 0.451), 2048: (3, 0.386), 4096: (3, 0.343)}
LESS = 0.85  # beyond, from one size to the next
CANDIDATES = 4  # corners of a rotation that probes choose from
BLOCK = 1024  # vectors of a block
SMALL = 32  # groups up to this size are compared many at a time
PAIRS_AT_ONCE = 20_000
ROUND_ROWS = 512
GROUP = ["bucket", "low", "high"]


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two numbers), scaled to keep lengths."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, -1, 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        step *= 2
    return x.reshape(rows, n) / np.sqrt(n)


def padded(size: int) -> int:
    """The power of two that vectors of ``size`` numbers are turned in."""
    return max(min(MEET), 1 << (size - 1).bit_length())


def tables_for(size: int, recall: float = RECALL) -> tuple[int, int]:
    """Tables and rotations with which a pair of ``size`` numbers at the cosine shares a bucket with probability ``recall``."""
    wide, last = padded(size), max(MEET)
    rotations, meet = MEET[min(wide, last)]
    meet *= LESS ** max(0, wide.bit_length() - last.bit_length())
    return math.ceil(math.log(1 - recall) / math.log(1 - meet)), rotations


def bucket_codes(x: np.ndarray, probes: int = PROBES, seed: int = 1) -> np.ndarray:
    """Codes of the most likely buckets, ``rows x tables x probes``, the likeliest first. Rows have length 1."""
    rows, size = x.shape
    wide, (tables, rotations) = padded(size), tables_for(size)
    if size < min(MEET):  # signs alone would turn few numbers in few ways
        x = x @ np.linalg.qr(np.random.default_rng([seed, size]).normal(size=(wide, size)))[0].T
    else:
        x = np.pad(x, ((0, 0), (0, wide - size)))
    random = np.random.default_rng(seed)
    picked = min(CANDIDATES, wide)
    choices = np.array(list(itertools.product(range(picked), repeat=rotations)))
    out = np.zeros((rows, tables, min(probes, len(choices))), np.int64)
    for table in range(tables):
        loss = np.zeros((rows, len(choices)))
        code = np.zeros((rows, len(choices)), np.int64)
        for turn in range(rotations):
            y = x
            for sign in random.choice([-1.0, 1.0], (3, wide)):
                y = hadamard(y * sign)
            largest = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :picked]
            value = np.take_along_axis(y, largest, 1)
            corner = largest * 2 + (value < 0)
            loss += (np.abs(value[:, :1]) - np.abs(value))[:, choices[:, turn]]
            code = code * (2 * wide) + corner[:, choices[:, turn]]
        best = np.argsort(loss, axis=1, kind="stable")[:, :out.shape[2]]
        out[:, table] = np.take_along_axis(code, best, 1)
    return out


def _usable(stored: str):
    """Row id, and a key for equal vectors (null for those that link with nothing) with the vector's numbers as ``stored``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vectors = [], []
            for value in batch.column("vector").to_pylist():
                key = raw = None
                if value is not None and len(value) and all(v is not None for v in value):
                    own = np.array(value, np.float64) + 0.0
                    if np.isfinite(own).all() and own.any():
                        raw = own.astype(stored).tobytes()
                        key = hashlib.blake2b(raw, digest_size=16).digest()
                keys.append(key)
                vectors.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["vec_id", "key", "vector"])

    return run


def _unit(values, stored: str) -> np.ndarray:
    x = np.frombuffer(b"".join(values), stored).reshape(len(values), -1).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _code_type(size: int) -> type:
    """The smallest kind of number that holds a bucket's code for vectors of ``size`` numbers."""
    return np.int32 if (2 * padded(size)) ** tables_for(size)[1] < 1 << 31 else np.int64


def _names(codes: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Buckets by name: of code, table and vector size."""
    return ta.mix(ta.mix(codes.astype(np.uint64) * np.uint64(64) + table.astype(np.uint64)) + np.uint64(size)).astype(np.int64)


def _codes(stored: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["vector"].map(len) // np.dtype(stored).itemsize
            for size, part in frame.groupby(sizes):
                for at in range(0, len(part), ROUND_ROWS):
                    own = part.iloc[at:at + ROUND_ROWS]
                    codes = bucket_codes(_unit(own["vector"], stored))
                    named = _names(codes, np.arange(codes.shape[1])[None, :, None], size).reshape(len(own), -1)
                    packed = codes.astype(_code_type(size)).reshape(len(own), -1)
                    yield pd.DataFrame({"key": own["key"].to_numpy(), "buckets": list(named), "codes": [r.tobytes() for r in packed]})

    return run


def _first_shared(one: np.ndarray, two: np.ndarray, bucket: np.ndarray, size: int) -> np.ndarray:
    """For each pair of rows of codes (``pairs x tables x probes``), whether ``bucket`` is the first that they share."""
    equal = (one[:, :, :, None] == two[:, :, None, :]).any(axis=3)
    table, rows = equal.any(axis=2).argmax(axis=1), np.arange(len(one))
    least = np.where(equal[rows, table], one[rows, table], np.iinfo(one.dtype).max).min(axis=1)
    return _names(least, table, size) == bucket


def _near_pairs(x: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group at the cosine; rows of a group are neighbours, ``group`` numbers them from 0."""
    left, right = [], []
    small = sizes[group] <= SMALL
    for step in range(1, min(SMALL, len(x))):
        a = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        if not len(a):
            break
        for at in range(0, len(a), PAIRS_AT_ONCE):
            part = a[at:at + PAIRS_AT_ONCE]
            near = part[np.einsum("ij,ij->i", x[part], x[part + step]) >= COSINE]
            left.append(near)
            right.append(near + step)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for g in np.flatnonzero(sizes > SMALL):
        own = x[starts[g]:starts[g + 1]]
        for at in range(0, len(own), 256):
            a, b = np.nonzero(own[at:at + 256] @ own.T >= COSINE)
            later = b > a + at
            left.append(starts[g] + at + a[later])
            right.append(starts[g] + b[later])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _spanning(left: np.ndarray, right: np.ndarray) -> dict[int, int]:
    """A root for every row that has a link."""
    root: dict[int, int] = {}

    def find(n: int) -> int:
        while (up := root.setdefault(n, n)) != n:
            root[n] = n = root[up]
        return n

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in list(root)}


def _linked(rows: pd.DataFrame, stored: str) -> pd.DataFrame | None:
    """Verified links among whole groups: for each key with how many vectors it links, and edges that span its links.

    The vectors have one size.
    """
    rows = rows.drop_duplicates([*GROUP, "key"]).reset_index(drop=True)
    if len(rows) < 2:
        return None
    x = _unit(rows["vector"], stored)
    keys = rows[GROUP].to_numpy()
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    group = np.cumsum(new) - 1
    a, b = _near_pairs(x, group, np.bincount(group))
    if len(a):
        block, across = rows["block"].to_numpy(), rows["low"].to_numpy() != rows["high"].to_numpy()
        kept = ~(across[a] & (block[a] == block[b]))
        a, b = a[kept], b[kept]
    if len(a):
        size = x.shape[1]
        codes = np.frombuffer(b"".join(rows["codes"]), _code_type(size)).reshape(len(rows), tables_for(size)[0], -1)
        kept = np.concatenate([_first_shared(codes[p], codes[q], rows["bucket"].to_numpy()[p], size) for p, q in (
            (a[at:at + PAIRS_AT_ONCE], b[at:at + PAIRS_AT_ONCE]) for at in range(0, len(a), PAIRS_AT_ONCE))])
        a, b = a[kept], b[kept]
    if not len(a):
        return None
    copies, links = rows["copies"].to_numpy(), np.zeros(len(rows), np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    root, key = _spanning(a, b), rows["key"].to_numpy()
    some = np.array(sorted(root))
    return pd.DataFrame({"key": key[some], "links": links[some], "near": key[[root[i] for i in some]]})


def _links(stored: str):
    """The links of a stream sorted by group; groups that are complete are worked on together."""
    def linked(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, part in rows.groupby(rows["vector"].map(len)) if len(rows) else ():
            found = _linked(part, stored)
            if found is not None:
                yield found

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            last = (frame[GROUP] == frame[GROUP].iloc[-1]).all(axis=1).to_numpy()
            first_of_last = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if held and first_of_last == 0 and (held[-1][GROUP].iloc[-1] == frame[GROUP].iloc[0]).all():
                held.append(frame)
                continue
            yield from linked(pd.concat([*held, frame.iloc[:first_of_last]]))
            held = [frame.iloc[first_of_last:]]
        if held:
            yield from linked(pd.concat(held))

    return run


def near_duplicates(vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors that are null, empty, zero, or have null or non-finite components link with nothing; so do vectors of different
    sizes. Equal vectors are one class, compared once; every copy counts as a link. A group of links has the smallest id
    as ``component_id``; a vector without links has its own. Repeated rows count as vectors of their own with one id.
    An empty table gives an empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(vec).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    kind = dict(given.dtypes)["vec_id"]
    numbers = "float32" if dict(vectors.dtypes)[embedding] == "array<float>" else "float64"  # as they came
    rows = given.mapInArrow(_usable(numbers), f"vec_id {kind}, key binary, vector binary")
    stored = workspace.write_table(rows, workspace.new_path(spark, "vectors"))
    classes = workspace.write_table(
        stored.where("key IS NOT NULL").groupBy("key").agg(
            F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")),
        workspace.new_path(spark, "classes"))
    codes = workspace.write_table(
        classes.select("key", "vector").mapInPandas(_codes(numbers), "key binary, buckets array<long>, codes binary"), workspace.new_path(spark, "codes"))

    places = codes.select("key", F.explode(F.array_distinct("buckets")).alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count("*").alias("weight")).where("weight > 1")
    shared = workspace.write_table(shared, workspace.new_path(spark, "shared"))
    members = places.join(shared.select("bucket"), "bucket", "left_semi")
    narrow = block_pairs(members, shared, "bucket", "key", BLOCK)
    full = narrow.join(classes.select("key", "copies", "vector").join(codes.select("key", "codes"), "key"), "key")
    found = (
        full.repartition(*GROUP).sortWithinPartitions(*GROUP)
        .mapInPandas(_links(numbers), "key binary, links long, near binary")
    )
    found = workspace.write_table(found, workspace.new_path(spark, "links"))
    return named_links(stored, classes, found, "vec_id").select("vec_id", "n_links", "component_id", "kept")
