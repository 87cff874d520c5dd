"""Token counts by byte-pair merging with a heap over a linked list of symbols."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerlens.llm.shipping import ship
from ledgerlens.llm.words import chunks

BLANK = "▁"  # stands for a space within pieces
# Each Python worker remembers the counts of so many short segments, twice; others are merged again.
REMEMBERED, REMEMBERED_CHARS = 400_000, 40


def load_pieces(path: str) -> dict[str, float]:
    """The rank of each piece of a sentencepiece model, the lower merged the sooner; no special or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): -model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


class MergeCounter(dict):
    """Maps a segment of text to its number of tokens, computed when it is first looked up."""

    def __init__(self, ranks: Mapping[str, float]):
        super().__init__()
        self.ranks, self.older = ranks, {}
        self.single = {p for p in ranks if len(p) == 1}
        # Two characters side by side in no piece are never merged: what lies between such borders
        # is counted by itself.
        self.joined = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        if any(p[1] == BLANK and p[0] != BLANK for p in self.joined):
            self.segments = None
        elif any("\n" in p for p in self.joined):
            self.segments = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        else:
            self.segments = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")

    def __missing__(self, segment: str) -> int:
        count = self.older.get(segment)
        if count is None:
            joined = self.joined
            cuts = [i for i in range(1, len(segment)) if segment[i - 1 : i + 1] not in joined]
            if cuts:
                count = sum(self[segment[i:j]] for i, j in zip([0, *cuts], [*cuts, len(segment)], strict=True))
            else:
                count = self.merge(segment)
        if len(segment) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[segment] = count
        return count

    def merge(self, segment: str) -> int:
        """Initial symbols minus merges. A character that is no piece counts with each of its bytes."""
        ranks, symbols, n = self.ranks, list(segment), len(segment)
        pairs = [(ranks[p], i, p) for i in range(n - 1) if (p := segment[i : i + 2]) in ranks]
        heapify(pairs)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        count = n
        while pairs:
            _, left, piece = heappop(pairs)
            right = after[left]
            # Stale if a side was merged since: it is gone, or longer than when the pair was found.
            if right >= n or (own := symbols[left]) is None or own + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, None
            count -= 1
            after[left] = end = after[right]
            if end < n:
                before[end] = left
                if (p := piece + symbols[end]) in ranks:
                    heappush(pairs, (ranks[p], left, p))
            if (start := before[left]) >= 0 and (p := symbols[start] + piece) in ranks:
                heappush(pairs, (ranks[p], start, p))
        if not self.single.issuperset(segment):
            count += sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in ranks)
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        symbols = BLANK + text.replace(" ", BLANK)
        if self.segments is None:
            return self.merge(symbols)
        return sum(map(self.__getitem__, self.segments.findall(symbols)))


_counters: dict[int, MergeCounter] = {}


def _counter(ranks: dict[str, float]) -> MergeCounter:
    """The worker's own counter for this vocabulary, kept between tasks."""
    key = hash(frozenset(ranks.items()))
    if key not in _counters:
        _counters.clear()
        _counters[key] = MergeCounter(ranks)
    return _counters[key]


def count_tokens(docs: DataFrame, pieces: Mapping[str, float], limit: int = 4096) -> DataFrame:
    """Per row doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``pieces`` are those of ``load_pieces``. Whole texts are counted, without begin or end tokens;
    strings that look like special tokens are ordinary text. Null and empty texts have no tokens.
    Each task holds one batch of rows, the vocabulary and a bounded memory of segments; nothing is
    shuffled. Rows may repeat; only the columns doc_id and text are read.
    """
    ship(docs.sparkSession)
    ranks = dict(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks)
        for batch in batches:
            for part in chunks(batch, "text"):
                text = part.column("text")
                tokens = np.array([counter.count(t) for t in text.to_pylist()], np.int64)
                n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), n_bytes, pa.array(tokens), pa.array(tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
