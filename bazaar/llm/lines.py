"""Line dedup: an exact set-similarity join over the lines of all documents.

A line's tokens are its distinct runs of WIDTH neighbouring words (A-Z as a-z). Single words would be too common: their
vocabulary stops growing while the corpus goes on, so that ever more lines share even their rarest ones. A line of fewer
words has one token, its whole sequence of words; lines without words always stay. A line is removed if an earlier line,
in the order of (doc_id, text hash, line number), has the same set of tokens or one of Jaccard similarity PERCENT / 100 or
more; the first of its kind stays.

Tokens are ordered by rarity in the corpus. One shuffle brings the prefix tokens of all lines together, sorted, and is
read as a stream: it yields the later ones of equal lines, and the tokens that different lines share. There, a line is
first verified against the earliest line of each token, which settles most; lines that are still open then meet all
earlier lines of their tokens. Length and positional filters come before any set is fetched.

Defined cases: null text stays null; rows without doc_id are left as they are and match nothing; rows that share a doc_id
are told apart by their text, and equal rows are one document; an empty table gives none; documents that lose every word
are dropped, unless asked for; other columns pass through, whatever their names, and n_chars, where there is one, is
counted anew for changed texts.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common, rarity
from bazaar.operators.joins import keyed_join

WIDTH = 5
PERCENT = 80


_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # the first k of eight bytes


def _word_hashes(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time: most words are one or two steps."""
    padded = np.concatenate((a, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray((len(a) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))  # the eight bytes from each place on
    size = ends - starts
    h = common.mixed((eight[starts] & _LOW[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD)
    at, more = 8, np.flatnonzero(size > 8)
    while len(more):
        h[more] = common.mixed(h[more] * _ODD + (eight[starts[more] + at] & _LOW[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    return h


def tokens(texts: list[str | None], width: int = WIDTH) -> np.ndarray:
    """All tokens of texts' lines, repeats included, in any order."""
    h, words, _ = _hashed_words(texts)
    return np.concatenate([hashes for _, hashes in _runs(h, words, width)])


def _hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash per word, number of words per line (of all texts), number of lines per text."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    a = np.frombuffer(b"\n".join(raw), dtype=np.uint8)
    starts, ends = common.word_spans(a)
    before = np.searchsorted(starts, np.flatnonzero(a == 10))  # words before the end of each line
    words = np.diff(before, prepend=0, append=len(starts))
    return _word_hashes(a, starts, ends), words, np.array([r.count(b"\n") + 1 for r in raw], dtype=np.int64)


def _runs(h: np.ndarray, words: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Line and hash of the runs of `width` words within a line; then of shorter lines: one run of all their words."""
    first = np.cumsum(words) - words
    full = np.flatnonzero(np.arange(len(h)) <= np.repeat(first + words - width, words))
    yield np.repeat(np.arange(len(words)), np.maximum(words - width + 1, 0)), common.windows(h, width)[full] if len(full) else h[:0]
    for k in range(1, width):
        at = np.flatnonzero(words == k)
        yield at, common.windows(h[(first[at, None] + np.arange(k)).ravel()], k)[::k]


def _line_tokens(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line (index over all texts) and hash per token, in any order; and per line its text and its number there."""
    h, words, per_text = _hashed_words(texts)
    text_of = np.repeat(np.arange(len(per_text)), per_text)
    number = np.arange(len(text_of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    line, hashes = (np.concatenate(x) for x in zip(*_runs(h, words, width), strict=True))
    return line, hashes, text_of, number


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


#: A line's place: its document's id, and a hash of the document's text (32 bits) followed by the line number (32 bits).
PLACE = ["doc", "at"]
_PLACE = "doc long, at long"


def _at(th: np.ndarray, line: np.ndarray) -> np.ndarray:
    return (th.astype(np.int64) << 32) | line


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, th, text: documents by id and text, which tell rows apart that share an id."""
    text_hash = F.shiftright(F.xxhash64("text"), 32).cast("int").alias("th")
    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc"), text_hash, "text")


def _entries(rows: DataFrame, table: np.ndarray, width: int, percent: int) -> DataFrame:
    """Prefix tokens of all lines: token, kind (the line's signature and size, 32 bits each), place and the token's position.

    A token's bits are put in another order: the rank of its bucket's rarity, then the rest of the hash, so that numbers
    ascend as tokens do in the global order. Lines are equal if token, position, signature and size are: some 100 bits.
    """
    bits = len(table).bit_length() - 1
    rank = np.empty(len(table), dtype=np.uint64)
    rank[np.argsort(table, kind="stable")] = np.arange(len(table), dtype=np.uint64)
    ranks, rest = docs_ranks(rows, rank << np.uint64(64 - bits)), np.uint64((1 << (64 - bits)) - 1)

    def of(ids: np.ndarray, th: np.ndarray, texts: list[str | None]) -> pa.RecordBatch:
        line, h, text_of, number = _line_tokens(texts, width)
        h = ranks.value[rarity.bucket(h, bits)] | (h & rest)
        by = np.argsort(h)
        by = by[np.argsort(line[by].astype(np.uint16 if len(text_of) < 1 << 16 else np.int64), kind="stable")]
        line, h = line[by], h[by]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
        line, h = line[new], h[new]
        n = np.bincount(line, minlength=len(text_of))
        first = np.cumsum(n) - n
        some = np.flatnonzero(n)
        signature = np.zeros(len(text_of), dtype=np.uint64)
        if len(some):
            signature[some] = np.add.reduceat(common.mixed(h + np.uint64(1)), first[some])
        pos = np.arange(len(h)) - first[line]
        head = pos < _prefix(n, percent)[line]
        line, h, pos = line[head], h[head], pos[head]
        text = text_of[line]
        columns = [
            pa.array(common.signed(h)), pa.array((common.signed(signature[line]) & ~0xFFFFFFFF) | n[line]), pa.array(ids[text]),
            pa.array(_at(th[text], number[line])), pa.array(pos.astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["token", "kind", *PLACE, "pos"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            ids, th = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for part in common.slices(texts, 128):
                yield of(ids[part], th[part], texts[part])
        common.release()

    return rows.mapInArrow(run, f"token long, kind long, {_PLACE}, pos int")


def docs_ranks(rows: DataFrame, ranks: np.ndarray):
    """The order of the buckets for all tasks: a table of fixed size."""
    return rows.sparkSession.sparkContext.broadcast(ranks)


def _met(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted entries -> later ones of equal lines (`later`), and entries of tokens that different lines share.

    Only the last line seen is held between batches.
    """
    held: pd.DataFrame | None = None  # the first entry of the last line seen
    shown = False  # whether it has been returned
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        token, kind, doc, at_ = (rows[c].to_numpy() for c in ("token", "kind", *PLACE))
        same_token = np.concatenate(([False], token[1:] == token[:-1]))
        first = ~(same_token & np.concatenate(([False], kind[1:] == kind[:-1])))
        at = np.flatnonzero(first)
        owner = at[np.cumsum(first) - 1]
        later = ~first & (rows["pos"].to_numpy() == 0) & ((doc != doc[owner]) | (at_ != at_[owner]))
        again = token[at[1:]] == token[at[:-1]]  # another line of the same token
        keep = np.zeros(len(rows), dtype=bool)
        keep[at[1:][again]] = True
        keep[at[:-1][again]] = True
        if held is not None and shown:
            keep[0] = False
        shown = bool((len(at) > 1 and again[-1]) or (len(at) == 1 and held is not None and shown))
        held = rows.iloc[[at[-1]]]
        out = rows[keep | later]
        yield out.assign(later=later[keep | later])


def _ordered(a: str, b: str) -> Column:
    """Line a is earlier than line b."""
    return F.struct(*[f"{c}_{a}" for c in PLACE]) < F.struct(*[f"{c}_{b}" for c in PLACE])


def _fits(percent: int) -> Column:
    n_x, n_y = F.col("n_x"), F.col("n_y")
    rest = F.least(n_x - F.col("pos_x"), n_y - F.col("pos_y"))
    return (F.least(n_x, n_y) * 100 >= F.greatest(n_x, n_y) * percent) & (rest * (100 + percent) >= (n_x + n_y) * percent)


def _named(rows: DataFrame, side: str) -> list[Column]:
    return [F.col(c).alias(f"{c}_{side}") for c in PLACE]


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("token", *_named(rows, name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "pos")])


_PAIR = tuple(f"{c}_{side}" for side in "xy" for c in PLACE)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Places of the lines x that some pair's y is similar to."""
    for side in "xy":
        named = sets.select(*_named(sets, side), F.col("set").alias(f"set_{side}"))
        # One way of joining at every size: sets grow with the corpus and are never broadcast.
        pairs = keyed_join(pairs, named.hint("shuffle_hash"), [f"{c}_{side}" for c in PLACE], "inner")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_x").to_pylist(), batch.column("set_y").to_pylist(), strict=True):
                a, b = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                both = np.sort(np.concatenate((a, b)))
                keep.append((100 + percent) * int((both[1:] == both[:-1]).sum()) >= percent * (len(a) + len(b)))
            yield batch.select([f"{c}_x" for c in PLACE]).filter(pa.array(keep, pa.bool_())).rename_columns(PLACE)

    rows = pairs.select(*[f"{c}_x" for c in PLACE], "set_x", "set_y")
    return common.saved(rows.mapInArrow(work, _PLACE).distinct(), "similar-lines")


def _parts() -> list[Column]:
    """Text hash and line number of a place."""
    return [F.shiftright("at", 32).cast("int").alias("th"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("line")]


def _sets(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Token sets of the wanted lines, sorted."""
    per = wanted.select(*PLACE).distinct().select("doc", *_parts()).groupBy("doc", "th").agg(F.collect_list("line").alias("lines"))
    texts = keyed_join(rows, per.hint("shuffle_hash"), ["doc", "th"], "inner")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for run in common.slices(texts, 128):
                part = batch.slice(run.start, run.stop - run.start)
                line, h, text_of, number = _line_tokens(texts[run], width)
                by = np.argsort(line, kind="stable")
                line, h = line[by], h[by]
                ids, th = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "th"))
                cuts = np.searchsorted(line, np.arange(len(text_of) + 1))
                start = np.searchsorted(text_of, np.arange(part.num_rows))  # a text's first line
                at = [(i, start[i] + x) for i, xs in enumerate(part.column("lines").to_pylist()) for x in sorted(set(xs))]
                text = np.array([i for i, _ in at], dtype=np.int64)
                every = np.array([k for _, k in at], dtype=np.int64)
                found = [np.unique(h[cuts[k] : cuts[k + 1]]).astype("<u8").tobytes() for k in every]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[text]), pa.array(_at(th[text], number[every])), pa.array(found, pa.binary())],
                    names=[*PLACE, "set"],
                )

    return common.saved(texts.select("doc", "th", "text", "lines").mapInArrow(work, f"{_PLACE}, set binary"), "line-sets")


def removed(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc, th, line) of every line to remove: its document's id and text hash, and its number there."""
    rows, spark = _keyed(docs), docs.sparkSession
    table = rarity.counts(rows, lambda t: tokens(t, width), many=True)
    order = ["token", "kind", *PLACE]
    sorted_ = _entries(rows, table, width, percent).repartition("token").sortWithinPartitions(*order)
    schema = f"token long, kind long, {_PLACE}, pos int, later boolean"
    with common.large_batches(spark):
        met = common.saved(sorted_.mapInPandas(_met, schema), "met")
    later = met.filter("later").select(*PLACE)
    size = F.col("kind").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("n")
    entries = met.filter("NOT later").select("token", *PLACE, size, "pos")
    sets = _sets(rows, entries, width)

    head = entries.groupBy("token").agg(F.min(F.struct(*PLACE, "n", "pos")).alias("h"))
    head = _side(head.select("token", "h.*"), "y")
    pairs = keyed_join(_side(entries, "x"), head.hint("shuffle_hash"), ["token"], "inner", _fits(percent) & _ordered("y", "x"))
    pairs = common.saved(pairs.select(*_PAIR).distinct(), "line-pairs")
    with common.large_batches(spark):
        settled = _verified(pairs, sets, percent)

    known = common.saved(settled.unionByName(later).distinct(), "settled-lines")
    open_ = keyed_join(entries, known.hint("shuffle_hash"), PLACE, "left_anti")
    rest = keyed_join(_side(open_, "x"), _side(entries, "y").hint("shuffle_hash"), ["token"], "inner", _fits(percent) & _ordered("y", "x"))
    rest = keyed_join(rest.select(*_PAIR).distinct(), pairs.hint("shuffle_hash"), list(_PAIR), "left_anti")
    with common.large_batches(spark):
        more = _verified(rest, sets, percent)
    return known.unionByName(more).distinct().select("doc", *_parts())


def deduplicated(docs: DataFrame, keep_empty: bool = False, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, without their removed lines."""
    per = removed(docs, width, percent).groupBy("doc", "th").agg(F.collect_list("line").alias("gone"))
    per = common.saved(per, "removed-lines")
    names = docs.columns
    key = F.shiftright(F.xxhash64("text"), 32).cast("int").alias("th")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("doc"), key)
    # Documents with removed lines meet their numbers; a wrong row never does, and no text is shuffled if they are few.
    joined = keyed_join(rows, per, ["doc", "th"])
    kept = F.filter(F.split("row.text", "\n", -1), lambda _, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    joined = joined.withColumn("left", text).withColumn("changed", F.col("gone").isNotNull())
    if not keep_empty:
        joined = joined.filter(~F.col("changed") | F.col("left").rlike(common.WORD))
    out = {c: F.col(f"row.`{c}`") for c in names} | {"text": F.col("left")}
    if "n_chars" in names:
        out["n_chars"] = F.when(F.col("changed"), F.length("left").cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return joined.select(*[v.alias(c) for c, v in out.items()])
