"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the k smallest hashes of a set, ascending, with k fixed for all. Sketches of parts merge into the sketch of
the union, so a long text or a whole corpus is sketched piece by piece. A set of fewer than k shingles is held whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import CHUNK, batch, runs, ship
from weirflow.llm.ordered import in_runs
from weirflow.llm.shingles import shingle_sets

#: Standard error of a resemblance r is sqrt(r * (1 - r) / K), 0.031 at most.
K, WORDS = 256, 5
#: Bits kept of a hash: enough to tell apart the shingles of 10^10 and more, in three quarters of the space of 64.
BITS = 48


def sketches(texts: list[bytes], k: int = K, words: int = WORDS) -> list[np.ndarray]:
    """The sketch of each text. One without words has an empty sketch."""
    drop = np.uint64(64 - BITS)
    return [np.unique(keys[: k + 8] >> drop)[:k] for run in runs(map(len, texts)) for keys in shingle_sets(texts[run], words)]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; two empty sets are alike."""
    both = merge(a, b, k)
    return float(np.isin(np.intersect1d(a, b, assume_unique=True), both).sum() / len(both)) if len(both) else 1.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; an empty set is contained in any."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    """Six bytes of each hash, as base64."""
    return base64.b64encode(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return from_bytes(base64.b64decode(text))


def from_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // BITS, 8), np.uint8)
    out[:, : BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    return out.view("<u8").ravel()


def fingerprint(docs: DataFrame, text: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """All columns of ``docs`` and ``fingerprint``, the sketch of each text as base64. Null counts as empty."""
    ship(docs.sparkSession)

    def sketch(series):
        texts = [(x or "").encode() for x in series]
        return type(series)([to_text(s) for s in sketches(texts, k, words)], dtype=object)

    return docs.withColumn("fingerprint", F.pandas_udf(sketch, "string")(F.col(text)))


def corpus_fingerprint(docs: DataFrame, by: str, text: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """(by, fingerprint) of all texts of each group, for instance of each source.

    The sketches are merged within each task before the shuffle: k hashes per group and task are moved.
    """
    ship(docs.sparkSession)
    hashes = fingerprint(docs.select(by, text), text, k, words).select(by, F.unbase64("fingerprint").alias("s"))

    def parts(batches):
        held: dict = {}
        for part in batches:
            for group, s in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held[group] = merge(held.get(group, np.zeros(0, np.uint64)), from_bytes(s), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([base64.b64decode(to_text(s)) for s in held.values()], pa.binary())], names=[by, "s"]
        )

    def whole(key, pdf):
        both = np.zeros(0, np.uint64)
        for s in pdf["s"]:
            both = merge(both, from_bytes(s), k)
        return pdf.iloc[:1].assign(fingerprint=to_text(both))[[by, "fingerprint"]]

    local = hashes.withColumn(by, F.col(by).cast("string")).mapInArrow(parts, f"`{by}` string, s binary")
    return local.groupBy(by).applyInPandas(whole, f"`{by}` string, fingerprint string")


def _with_next(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Each row that is no guest, with the text of the row behind it."""
    last = None
    for run, doc_id, text, guest in rows:
        if last and last[0] == run and not last[3]:
            yield last[1], last[2], text
        last = (run, doc_id, text, guest)


def compare_with_next(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document by doc_id.

    The edited text has the last floor(n/2) of its n code points replaced by the first as many (or all) of the next
    document's; the last document is followed by the first. ``docs`` has doc_id and text; other columns are not read. Null
    texts count as empty, a null doc_id stands before all others; rows of one doc_id stand in the order of their
    texts. Two empty sets have likeness 1. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    fields += [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    schema = pa.schema(fields)

    def judged(held: list[tuple]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for _, t, after in held]
        own = sketches([t.encode() for _, t, _ in held] + [held[-1][2].encode()], k, words)
        # A run of the order has each text twice, as itself and as the one after: the sketch is made once.
        following = [
            own[i + 1] if i + 1 == len(held) or held[i][2] is held[i + 1][1] else sketches([held[i][2].encode()], k, words)[0]
            for i in range(len(held))
        ]
        edited = [t.encode() for t in edited]
        other = sketches(edited, k, words)
        return batch(
            schema,
            [i for i, _, _ in held],
            [len(t) for _, t, _ in held],
            [sha256(t).hexdigest() for t in edited],
            [to_text(s) for s in own[:-1]],
            [to_text(s) for s in other],
            [resemblance(a, b, k) for a, b in zip(own, other)],
            [resemblance(a, b, k) for a, b in zip(own, following)],
        )

    def judge(batches):
        rows = (
            row
            for part in batches
            for row in zip(*(part.column(i).to_pylist() for i in range(4)))
        )
        held, size = [], 0
        for row in _with_next(rows):
            held.append(row)
            size += len(row[1])
            if size >= CHUNK:
                yield judged(held)
                held, size = [], 0
        if held:
            yield judged(held)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("place"),
    )
    placed = in_runs(rows, "place", wrap=True).sortWithinPartitions("run", "guest", "place", "text")
    return placed.select("run", "doc_id", "text", "guest").mapInArrow(
        judge,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
