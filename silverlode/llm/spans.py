"""What the two span finders share: a bounded sample of documents and the digest of spans."""

import hashlib
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize

#: Documents that a model is fitted on, at most, in the order of seeded hashes of their ids.
SAMPLE = 8000

Span = tuple[int, int, int]


def sampled(docs: DataFrame, id: str, text: str, size: int = SAMPLE) -> DataFrame:
    """Texts of at most ``size`` documents; their ids, bounded by it, are broadcast."""
    ids = docs.select(F.col(id).alias("_sid")).where("_sid is not null").orderBy(F.xxhash64(F.lit(3), "_sid"), "_sid").limit(size)
    ids = materialize(ids.distinct(), "span-sample")
    slim = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where("text is not null")
    return slim.join(F.broadcast(ids), F.col("id") == F.col("_sid"), "left_semi")


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span], kinds: tuple[str, ...]) -> str:
    return hashlib.sha256(joined(spans, kinds).encode()).hexdigest()


class Covered:
    """The stretches that spans cover, merged and in order, so that each question is a binary search."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted((a, b) for _, a, b in spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        """Whether any span shares a character with ``[start, end)``."""
        at = bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] < end
