"""Token counts of whole texts without their ids.

A text falls into segments that no piece of the vocabulary reaches across: a run of spaces with what follows it up to
the next space, and runs of characters that no piece holds, such as line ends. Merges inside a segment don't depend on
what is around it, so the tokens of a text are the tokens of its segments.

1. Distinct segments are counted over all texts, within each task first.
2. Each distinct segment is tokenised once.
3. Each text's segment frequencies are joined to these counts and summed. The most frequent segments, ``KNOWN`` at
   most, go to all executors and are summed where the text is read; the rest, none of which makes up much more than one
   in ``KNOWN`` of all segments, is joined by shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.tables import stored

LIMIT = 4096
#: Segments that are broadcast, each as a key of at most 65 characters and a number.
KNOWN = 1 << 18
#: Longer segments go by a digest.
KEY_CHARS = 32
#: Distinct segments a task holds before it gives them away; entries of one row of frequencies; rows taken at once.
HELD, ENTRIES, ROWS = 1 << 18, 4096, 256
SPACE = "▁"  # how a piece writes a space


class Segments:
    """A sentencepiece BPE model and the places where its texts may be cut."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in ids if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        probe = f"a{SPACE}  ﬁ ①\tb "
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) or self.model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError(f"{path} changes texts or has pieces that go on after a space, so its texts can't be cut at spaces")
        used = set("".join(pieces))
        alone = "".join(c for c in "\n\r\t" if c not in used)
        self.pattern = re.compile(f" *[^ {alone}]+| +|[{alone}]+" if alone else " *[^ ]+| +")
        # a beginning that no segment grows together with
        self.before = alone[:1] or "x"
        self.before_tokens = len(self.model.encode(self.before))

    def of(self, text: str) -> list[str]:
        """The segments of a text, which the model takes with a space in front."""
        return self.pattern.findall(" " + text.replace(SPACE, " ")) if text else []

    def tokens(self, segments: list[str]) -> list[int]:
        """How many tokens each segment is."""
        return [len(ids) - self.before_tokens for ids in self.model.encode([self.before + s for s in segments], num_threads=1)]


@functools.lru_cache(maxsize=2)
def segments(path: str | None) -> Segments:
    import public_tokenizers

    return Segments(path or public_tokenizers.path("piece_bpe_32k.model"))


def key(segment: str) -> str:
    return segment if len(segment) <= KEY_CHARS else f"{hashlib.sha256(segment.encode()).hexdigest()}+"


def _texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows as tuples, few at a time."""
    for start in range(0, batch.num_rows, ROWS):
        part = batch.slice(start, ROWS)
        yield from zip(*[c.to_pylist() for c in part.columns], strict=True)


def _found(path: str | None) -> Callable:
    """(segment, times) of a task's texts; a segment comes again where the task held too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, held = segments(path).of, Counter()

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["segment", "times"])

        for batch in batches:
            for (text,) in _texts(batch):
                held.update(cut(text or ""))
                if len(held) >= HELD:
                    yield given()
                    held.clear()
        yield given()

    return run


def _tokenised(path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = part.column("segment").to_pylist()
                tokens = pa.array(segments(path).tokens(found), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(map(key, found))), part.column("times"), tokens], ["key", "times", "tokens"])

    return run


def _frequencies(path: str | None, shared) -> Callable:
    """(row, doc_id, n_bytes, known, keys, times): the tokens of known segments summed, the other segments with their
    frequencies. A text with many of these goes on in further rows, without n_bytes."""
    names = ["row", "doc_id", "n_bytes", "known", "keys", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = segments(path).of, shared.value
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                taken, own, sums, keys, times = [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    total, rest = 0, []
                    for segment, n in Counter(cut(text or "")).items():
                        k = key(segment)
                        if (tokens := known.get(k)) is None:
                            rest.append((k, n))
                        else:
                            total += n * tokens
                    for at in range(0, max(1, len(rest)), ENTRIES):
                        some = rest[at : at + ENTRIES]
                        taken.append(i)
                        own.append(at == 0)
                        sums.append(0 if at else total)
                        keys.append([k for k, _ in some])
                        times.append([n for _, n in some])
                at, own = pa.array(taken, pa.int64()), pa.array(own)
                size = pa.compute.if_else(own, part.column("n_bytes").take(at), pa.scalar(None, pa.int64()))
                arrays = [pa.array([number + i for i in taken], pa.int64()), part.column("doc_id").take(at), size, pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(keys, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))], names)
                number += part.num_rows

    return run


def vocabulary(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(key, times, tokens) of each distinct segment of all texts."""
    found = documents.select("text").mapInArrow(_found(path), "segment string, times long")
    distinct = found.groupBy("segment").agg(F.sum("times").alias("times"))
    return distinct.mapInArrow(_tokenised(path), "key string, times long, tokens long")


def _often(pieces: DataFrame, known: int) -> dict[str, int]:
    """The tokens of the most frequent segments, ``known`` at most: all those above a frequency. Frequencies are counted
    in sixteenths of a power of two, so a few hundred numbers come to the driver before them."""
    level = F.floor(F.log2("times") * 16)
    found = pieces.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()
    least, n = None, 0
    for r in found:
        n += r.n
        if n > known:
            break
        least = r.level
    if least is None:
        return {}
    top = pieces.where(level >= least).select("key", "tokens").toArrow()
    return dict(zip(top.column("key").to_pylist(), top.column("tokens").to_pylist(), strict=True))


def counted(documents: DataFrame, path: str | None = None, limit: int = LIMIT, known: int = KNOWN) -> DataFrame:
    """doc_id, n_bytes, n_tokens (long) and over_limit (n_tokens > ``limit``) for each row of ``documents``.

    Tokens are those that sentencepiece with the model at ``path`` (default: the public 32k BPE, read on each executor)
    gives for the whole text, without begin and end; names of special tokens in a text are ordinary text. Null texts
    count as empty, which is no bytes and no tokens. Ids may be null, repeat or be of any type; rows stay apart. Other
    columns are not looked at. No rows give no rows. A model whose texts can't be cut at spaces is refused.
    """
    spark = documents.sparkSession
    pieces = stored(vocabulary(documents, path), "pieces")
    shared = spark.sparkContext.broadcast(_often(pieces, known))
    docs = documents.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    numbers = [T.StructField(n, T.LongType()) for n in ("n_bytes", "known")]
    lists = [T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
    kinds = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), *numbers, *lists])
    texts = stored(docs.mapInArrow(_frequencies(path, shared), kinds), "frequencies", compression="zstd")
    rest = texts.select("row", F.explode(F.arrays_zip("keys", "times")).alias("e")).select("row", F.col("e.keys").alias("key"), F.col("e.times").alias("n"))
    sums = rest.join(pieces.select("key", "tokens"), "key").groupBy("row").agg(F.sum(F.col("n") * F.col("tokens")).alias("more"))
    own = texts.where(F.col("n_bytes").isNotNull()).select("row", "doc_id", "n_bytes", "known")
    n_tokens = (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    return own.join(sums, "row", "left").select("doc_id", "n_bytes", n_tokens).withColumn("over_limit", F.col("n_tokens") > limit)
