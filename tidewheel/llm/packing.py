"""Tokens of documents packed into windows of equal size by best-fit decreasing.

Each scan task tokenises its own texts and packs them in groups of about ``GROUP_TOKENS`` tokens, so nothing is
shuffled and a task holds one group at a time. Texts longer than a window are first cut into full windows; the rests
go, longest first, each into the open window with the least room that suffices. That window is found by a segment
tree over remaining capacities. If more than ``MAX_PADDING`` of the windows would be padding, the emptiest are taken
apart and cut to fill the others.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark import TaskContext

CAPACITY, END_ID = 2048, 1
GROUP_TOKENS, MAX_PADDING = 1 << 22, 0.005


@functools.lru_cache(maxsize=4)
def _encoding(ranks_path: str, pattern: str, model_path: str | None = None):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    added = {}
    if model_path:
        with open(model_path, encoding="utf-8") as model:
            added = {t["content"]: t["id"] for t in json.load(model)["added_tokens"]}
        # an added token's id is not one of the merges
        ranks = {token: i for token, i in ranks.items() if i not in set(added.values())}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)


def tokenizer(ranks_path: str | None = None, pattern: str | None = None) -> Callable[[str], np.ndarray]:
    """Text to ids by the byte-level BPE of ``byte_bpe_50k``, special tokens being ordinary text."""
    import public_tokenizers

    encoding = _encoding(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    return lambda text: encoding.encode_to_numpy(text, disallowed_special=())


def model_tokenizer() -> Callable[[str], np.ndarray]:
    """Text to ids as the tokenizer loaded from ``byte_bpe_50k.json`` gives them: an added token in a text is its one id."""
    import public_tokenizers

    encoding = _encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


class Windows:
    """Open windows by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)  # how many open windows have a room below this node
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = 0

    def _add(self, room: int, n: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += n
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of ``length`` or more that some window has."""
        node = self.leaves + length
        if self.tree[node]:
            return length
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def put(self, length: int) -> int:
        """The number of the window that takes a piece of ``length``."""
        room = self.tightest(length)
        if room is None:
            window, room = self.count, self.capacity
            self.count += 1
        else:
            window = self.open[room].pop()
            self._add(room, -1)
        if room > length:
            self.open[room - length].append(window)
            self._add(room - length, 1)
        return window


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece; ``lengths`` are at most ``capacity`` and taken longest first, in order among equals."""
    windows, out = Windows(capacity), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        out[i] = windows.put(int(lengths[i]))
    return out


def pack(doc_tokens: np.ndarray, capacity: int = CAPACITY, max_padding: float = MAX_PADDING) -> pd.DataFrame:
    """(doc, start, length, window, offset) for documents of so many tokens; windows from 0, gapless offsets in each."""
    full, rest = doc_tokens // capacity, doc_tokens % capacity
    doc = np.concatenate((np.repeat(np.arange(len(full)), full), np.flatnonzero(rest)))
    within = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    start = np.concatenate((within, full[rest > 0])) * capacity
    length = np.concatenate((np.full(full.sum(), capacity), rest[rest > 0]))
    window = best_fit(length, capacity)
    pieces = pd.DataFrame({"doc": doc, "start": start, "length": length, "window": window})
    used = np.bincount(window, length).astype(np.int64)
    least = -(-int(length.sum()) // capacity)
    if len(used) * capacity - length.sum() > max_padding * len(used) * capacity and len(used) > least:
        ranked = np.argsort(-used, kind="stable")
        new_name = np.empty(len(used), np.int64)
        new_name[ranked] = np.arange(len(used))
        pieces["window"] = new_name[window]
        room = (capacity - used[ranked])[:least]
        stay, moved = pieces[pieces["window"] < least], pieces[pieces["window"] >= least].sort_values(["doc", "start"])
        cut, target = [], least - 1
        for d, s, n in moved[["doc", "start", "length"]].itertuples(index=False):
            while n:
                while not room[target]:
                    target -= 1
                part = min(n, int(room[target]))
                cut.append((d, s, part, target))
                room[target] -= part
                s, n = s + part, n - part
        pieces = pd.concat([stay, pd.DataFrame(cut, columns=stay.columns)])
    pieces = pieces.sort_values(["window", "doc", "start"], kind="stable", ignore_index=True)
    before = pieces["length"].cumsum() - pieces["length"]
    pieces["offset"] = before - before.groupby(pieces["window"]).transform("first")
    return pieces


def _packed(capacity: int, ids_too: bool, tokens: Callable[[], Callable]) -> Callable:
    def group(docs: list, texts: list[np.ndarray], first: int) -> pd.DataFrame:
        sizes = np.array([len(t) for t in texts], np.int64)
        pieces = pack(sizes, capacity)
        cut = [texts[d][s : s + n] for d, s, n in pieces[["doc", "start", "length"]].itertuples(index=False)]
        out = pd.DataFrame({"doc_id": pd.Series([docs[d] for d in pieces["doc"]], dtype="Int64"), "start": pieces["start"], "length": pieces["length"]})
        out["ids"] = cut if ids_too else None
        out["ids_crc32"] = [zlib.crc32(c.astype("<u4").tobytes()) for c in cut]
        out["doc_tokens"] = sizes[pieces["doc"]]
        out["sequence_id"] = first + pieces["window"]
        out["offset"] = pieces["offset"]
        return out if ids_too else out.drop(columns="ids")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokens()
        end = np.array([END_ID], np.uint32)
        number = TaskContext.get().partitionId() << 36
        docs, texts, held = [], [], 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"].tolist(), frame["text"].tolist(), strict=True):
                ids = np.concatenate((encode(text), end)).astype(np.uint32) if text else end
                docs.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(ids)
                held += len(ids)
                if held >= GROUP_TOKENS:
                    out = group(docs, texts, number)
                    number = int(out["sequence_id"].max()) + 1
                    yield out
                    docs, texts, held = [], [], 0
        if docs:
            yield group(docs, texts, number)

    return run


def packed(documents: DataFrame, capacity: int = CAPACITY, ids: bool = True, tokens: Callable[[], Callable] = tokenizer) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (if wanted), ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text and one end id, so a null or empty text is that id alone, one piece. ``start`` is
    counted in its ids, ``offset`` in those of its sequence. Sequences are unique to a task's group, their numbers not
    dense. doc_id is an integer and may be null or repeat; rows stay apart. Other columns are not looked at. No rows
    give no rows.
    """
    kinds = "doc_id long, start long, length long, " + "ids array<long>, " * ids + "ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return documents.select("doc_id", "text").mapInPandas(_packed(capacity, ids, tokens), kinds)
