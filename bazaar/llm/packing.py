"""Best-fit packing of token sequences by minimum bin slack.

Pieces that have the same length are interchangeable, so packing is planned on the histogram of lengths: at most
`capacity` numbers, whatever the corpus. Each bin starts with the longest length left and takes the combination
of available lengths that fills the rest best, found by subset sums held as the bits of one integer. The same
combination then fills as many bins as the histogram allows, and its lengths are removed. Tasks place their
pieces by rank within the length: a rank is the task's offset (from counts per task and length) plus a local
number, so no length, however common, meets in one place.

Defined cases: null or empty text is one piece that holds only the end id; repeated rows are packed each; an empty
table gives none; only doc_id and text of the input are used, so no name clashes.
"""

import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import common

CAPACITY = 2048
END = 0
_CACHED = 600_000  # chunks of text that a worker remembers the ids of, some 50 bytes each; those that come again stay
_LONG = 1 << 20  # characters of a text that are looked at together
_STEP = 2_000  # chunks that the tokenizer gets at a time
_PROBES = ("a b", "Ab, cd. ef", "it's,\nx  y. 'z'", "é, ü. (x) 12,5", "word. Word word, wordword", "a.b c,d. e-f,", " lead and trail ", "\u00a0x\ty. z")


def vocabulary() -> str:
    """The tokenizer file that the query uses; other callers name their own."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end at blanks."""
    low = 0
    while len(text) - low > _LONG:
        cut = max(text.rfind(" ", low, low + _LONG), text.rfind("\n", low, low + _LONG))
        if cut < 0:  # one chunk longer than a part
            found = [k for k in (text.find(" ", low), text.find("\n", low)) if k >= 0]
            if not found:
                break
            cut = min(found)
        yield text[low:cut]
        low = cut + 1
    yield text[low:]


class Encoder:
    """Token ids of texts, remembered per chunk between blanks.

    A tokenizer that never joins across blanks, nor a letter with a comma or full stop after it, gives a text the ids of
    its chunks in order. That is tried on probes; a tokenizer that differs there gets whole texts (`by_chunk` is false).
    Chunks are found, told apart by 64-bit hashes and length, and put together as arrays; new ones go to the tokenizer many
    at a time, held apart by one of its special tokens, which no tokenizer joins with its neighbours.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = self._direct(["AÀ"]) == self._direct(["aà"])
        added = self.tokenizer.get_added_tokens_decoder()
        self.apart = next(((t.content, i) for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word)), None)
        self._forget()
        self.by_chunk = self.apart is not None
        if self.by_chunk:
            self.by_chunk = [x.tolist() for x in self._by_chunk(list(_PROBES))] == self._direct(list(_PROBES))
            self._forget()

    def _direct(self, texts: list[str]) -> list[list[int]]:
        fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> str:
        """The text in lower case, where the tokenizer does that anyway and no rule for other scripts can matter."""
        if not self.lowers or "<" in text:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def _forget(self) -> None:
        """Drop what is remembered. Chunk k of `keys` (sorted) has ids[first[k] : first[k] + count[k]] and `length` bytes.

        `again` marks those that came again after the call that learned them, or since the last thinning.
        """
        self.keys, self.length = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.first, self.count, self.ids = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint32)
        self.again = np.empty(0, dtype=bool)

    def _thin(self) -> None:
        """Drop the chunks that did not come again; all, where too few would go."""
        kept = np.flatnonzero(self.again)
        if len(kept) > _CACHED // 2:
            return self._forget()
        self.ids, self.count = self._gather(kept)
        self.first = np.cumsum(self.count) - self.count
        self.keys, self.length, self.again = self.keys[kept], self.length[kept], np.zeros(len(kept), dtype=bool)

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and how many each has."""
        word, mark = self.apart
        flat, counts = [], []
        for low in range(0, len(chunks), _STEP):
            part = chunks[low : low + _STEP]
            if any(word[0] in c for c in part):  # might hold a special token
                found = self._direct(part)
                flat += [np.array(x, dtype=np.uint32) for x in found]
                counts.append(np.array([len(x) for x in found], dtype=np.int64))
                continue
            ids = np.array([*self._direct([word.join(part)])[0], mark], dtype=np.uint32)
            cuts = np.flatnonzero(ids == mark)
            counts.append(np.diff(cuts, prepend=-1) - 1)
            flat.append(ids[ids != mark])
        return np.concatenate(flat), np.concatenate(counts)

    def _find(self, keys: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key among those remembered, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, (self.keys[at] == keys) & (self.length[at] == length)

    def _add(self, keys: np.ndarray, length: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, flat))
        merged = np.concatenate((self.keys, keys))
        by = np.argsort(merged, kind="stable")
        self.keys = merged[by]
        self.length, self.first, self.count = (np.concatenate(x)[by] for x in ((self.length, length), (self.first, first), (self.count, counts)))
        self.again = np.concatenate((self.again, np.zeros(len(keys), dtype=bool)))[by]

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of remembered chunks one after the other, and how many each has."""
        sizes = self.count[at]
        ends = np.cumsum(sizes)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[at] - ends + sizes, sizes)], sizes

    def _learn(self, a: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Remember new chunks; those that only add a comma or full stop to a word take the word's ids."""
        before = a[np.maximum(ends - 2, 0)]
        third = a[np.maximum(ends - 3, 0)]
        letter = ((before | 32) >= 97) & ((before | 32) <= 122) & (before < 128)
        letter |= (third == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7) & (ends - starts > 2)  # À to ÿ
        marked = (ends - starts > 1) & ((a[ends - 1] == 44) | (a[ends - 1] == 46)) & letter
        stems, stem_ends = starts[marked], ends[marked] - 1
        stem_keys = common.hash_spans(a, stems, stem_ends) if len(stems) else keys[:0]
        every = np.concatenate((keys[~marked], stem_keys))
        low, high = np.concatenate((starts[~marked], stems)), np.concatenate((ends[~marked], stem_ends))
        every, one = np.unique(every, return_index=True)
        low, high = low[one], high[one]
        new = ~self._find(every, high - low)[1]
        every, low, high = every[new], low[new], high[new]
        if len(every):
            raw = a.tobytes()
            self._add(every, high - low, *self._encoded([raw[s:e].decode() for s, e in zip(low.tolist(), high.tolist(), strict=True)]))
        if len(stems):
            at, _ = self._find(stem_keys, stem_ends - stems)
            flat, sizes = self._gather(at)
            comma, stop = (np.array(x, dtype=np.uint32) for x in self._direct([",", "."]))
            # One id per mark goes behind the ids of each word.
            tail = np.where(a[ends[marked] - 1] == 44, comma[0], stop[0])
            self._add(keys[marked], (ends - starts)[marked], np.insert(flat, np.cumsum(sizes), tail), sizes + 1)

    def _by_chunk(self, texts: list[str]) -> list[np.ndarray]:
        raw = [self._plain(t).replace("\n", " ").encode() for t in texts]
        a = np.frombuffer(b" ".join(raw), dtype=np.uint8)
        starts, ends = common.spans(a != 32)
        keys = common.hash_spans(a, starts, ends)
        unique, one, which = np.unique(keys, return_index=True, return_inverse=True)
        length = (ends - starts)[one]
        at, known = self._find(unique, length)
        if len(self.keys):
            self.again[at[known]] = True
        if not known.all():
            if len(self.keys) + len(unique) > _CACHED:
                self._thin()
                known = self._find(unique, length)[1]
            new = np.sort(one[~known])
            self._learn(a, keys[new], starts[new], ends[new])
            at, _ = self._find(unique, length)
        flat, sizes = self._gather(at[which])
        bounds = np.cumsum([0, *[len(r) + 1 for r in raw]])  # where each text begins
        cuts = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(starts, bounds)]
        return [flat[cuts[i] : cuts[i + 1]] for i in range(len(texts))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, without special tokens of the tokenizer's own."""
        plain = [t or "" for t in texts]
        if not self.by_chunk:
            return [np.array(x, dtype=np.uint32) for x in self._direct(plain)]
        if max(map(len, plain), default=0) <= _LONG:
            return self._by_chunk(plain)
        return [np.concatenate([self._by_chunk([part])[0] for part in _parts(t)]) for t in plain]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Documents as token pieces of at most `capacity`, each ending with the end id; numbered per task and length.

    `task` and `number` count the pieces of one length within one task. `keep_ids` adds the token ids.
    """
    schema = PIECE + ", task int, number long, _no_id boolean" + (", ids array<long>" if keep_ids else "")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, task = np.zeros(capacity + 1, dtype=np.int64), TaskContext.get().partitionId()
        for batch in batches:
            texts = list(batch["text"])
            for run in common.slices(texts, 256):
                part = batch.iloc[run]
                rows = []
                for doc_id, none, ids in zip(part["doc_id"], part["_no_id"], encoder(path).encode(texts[run]), strict=True):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        one = ids[start : start + capacity]
                        seen[len(one)] += 1
                        row = (doc_id, k, start, len(one), zlib.crc32(one.tobytes()), task, seen[len(one)] - 1, none)
                        rows.append((*row, one.astype(np.int64)) if keep_ids else row)
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out
        common.release()  # what the encoder remembers stays, for the worker's next task

    rows = common.with_ids(docs.select(F.col("doc_id").cast("long"), "text"))
    return common.ids_back(rows.mapInPandas(run, schema))


def fullest(lengths: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """(length, times) of the combination that fills `room` best, of (length, available), longest first."""
    bits, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, available in lengths:
        left, times = min(available, room // length), 1
        while left and not bits >> room:
            take = min(times, left)
            steps.append((length, take, bits))
            bits |= (bits << (length * take)) & mask
            left, times = left - take, times * 2
        if bits >> room:
            break
    goal, chosen = bits.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not (before >> goal) & 1:
            chosen[length] = chosen.get(length, 0) + take
            goal -= length * take
    return list(chosen.items())


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bins as (times per length, how many such bins), until the histogram is used up."""
    left, bins = {k: v for k, v in histogram.items() if v}, []
    order = sorted(left, reverse=True)
    while left:
        order = [x for x in order if x in left]
        first = order[0]
        others = [(x, left[x] - (x == first)) for x in order if x <= capacity - first]
        chosen = dict(fullest(others, capacity - first))
        chosen[first] = chosen.get(first, 0) + 1
        times = min(left[x] // n for x, n in chosen.items())
        bins.append((chosen, times))
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return bins


class Places:
    """Where the piece of a given rank within its length goes, by binary search."""

    def __init__(self, bins: list[tuple[dict[int, int], int]]):
        used: dict[int, int] = {}
        rows, offsets, base = [], [], 0
        for chosen, times in bins:
            at = 0
            for length, n in chosen.items():
                rows.append((length << 44 | used.get(length, 0), n, base, len(offsets)))
                used[length] = used.get(length, 0) + n * times
                offsets += range(at, at + n * length, length)
                at += n * length
            base += times
        self.keys, self.n, self.base, self.first = (np.array(x, dtype=np.int64) for x in zip(*sorted(rows), strict=True))
        self.offsets = np.array(offsets, dtype=np.int64)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length.astype(np.int64) << 44 | rank
        at = np.searchsorted(self.keys, key, side="right") - 1
        within = key - self.keys[at]
        return self.base[at] + within // self.n[at], self.offsets[self.first[at] + within % self.n[at]]


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset; with `ids` if asked, which make the sequences' tokens."""
    rows = common.saved(pieces(docs, path, capacity, keep_ids), "pieces")
    counts = common.saved(rows.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # Never broadcast: these rows grow with the tasks.
    ranked = rows.join(first.hint("shuffle_hash"), ["task", "length"]).withColumn("rank", F.col("first") + F.col("number"))
    names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * keep_ids
    schema = PIECE + ", ids array<long>" * keep_ids + ", sequence_id long, offset long"
    places = Places(plan({r["length"]: r["n"] for r in totals}, capacity)) if totals else None

    def place(batch: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = places.of(batch["length"].to_numpy(), batch["rank"].to_numpy())
        return batch[names].assign(sequence_id=sequence, offset=offset)

    return common.over_batches(ranked.select(*names, "rank"), place, schema, rows=20_000)
