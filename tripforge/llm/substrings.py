"""Substring dedup: windows of ``window`` words that also start in an earlier
document lose their words there; the first document keeps them.

Words are unchanged runs between ASCII white space.  A word goes when any window
that covers it also starts in a document with a smaller ``doc_id``; windows are
judged on the input, not on what is left of it.

Count-min prefilter.  Documents are packed into blocks of about a million words.
A block's sketch is, for each of ``ROWS`` hash rows, the set of counters its
windows fall on (a counter it meets twice is known to be repeated); the sketches
are merged counter by counter, each stretch of counters in a task of its own, so
the whole sketch, four counters a row to a window, is nowhere in one place.  The
merge answers each block with one bit for a counter: did others meet it too.  A
window that is alone on a counter of any row occurs once; all others are
estimated repeated, so none that is repeated is lost.  The second pass groups
exactly those by two independent 64-bit hashes (128 bits in all; a chance
collision among 1e13 windows has probability below 1e-12) and answers each block
with one bit for a window: does it start in a smaller document elsewhere.

Blocks are staged once, compressed, and stay where they are; what is shuffled is
a block's distinct counters and keys, so a passage in a third of all documents
is one row a block.  Answers lie in one file a block in the shared folder.

Null and empty texts have no words.  Rows without ``doc_id`` come after all ids.
Rows that repeat an id leave each other alone and are each returned.  Texts of
fewer words than a window are kept whole.  Extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import fresh_folder, open_fs, staged, write_file
from tripforge.llm.hashing import ODD, ODD2, PLAIN, hash_runs, hash_words, mixed

ROWS = 2                         # hash rows of the sketch
COUNTERS = 4                     # counters of a row to each window
STRETCH = 1 << 22                # counters that one task merges, at least
KEYS = 1 << 22                   # windows that one task of the second pass groups, about
LAST = np.iinfo(np.int64).max    # the place of rows without id

_LEVEL = 3


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=_LEVEL).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def blocks(docs: DataFrame, block_words: int = 1 << 20) -> DataFrame:
    """(block, n_words, data): documents packed into blocks, texts compressed."""
    def run(batches):
        ids, raw, size, n = [], [], 0, 0

        def close():
            nonlocal ids, raw, size, n
            head = np.array([len(ids)], "<i8").tobytes() + np.array([LAST if i is None else i for i in ids], "<i8").tobytes()
            head += np.array([i is None for i in ids], bool).tobytes() + np.array([len(r) for r in raw], "<i8").tobytes()
            row = pd.DataFrame([((TaskContext.get().partitionId() << 32) + n, size,
                                 zstandard.compress(head + b"".join(raw), _LEVEL))], columns=["block", "n_words", "data"])
            ids, raw, size, n = [], [], 0, n + 1
            return row
        for b in batches:
            for i, t in zip(b["doc_id"], b["text"]):
                r = (t or "").encode("utf-8")
                ids.append(None if pd.isna(i) else int(i))
                raw.append(r)
                size += r.count(b" ") + r.count(b"\n") + 1
                if size >= block_words:
                    yield close()
        if ids:
            yield close()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "block long, n_words long, data binary")


def _open(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    plain = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(plain, "<i8", 1)[0])
    ids, null = np.frombuffer(plain, "<i8", n, 8), np.frombuffer(plain, bool, n, 8 + 8 * n)
    ends = 8 + 17 * n + np.concatenate(([0], np.cumsum(np.frombuffer(plain, "<i8", n, 8 + 9 * n))))
    return ids, null, [plain[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Block:
    """Words and windows of a block; ``at`` are the first words of its windows."""

    def __init__(self, data: bytes, window: int):
        self.ids, self.null, self.raw = _open(data)
        self.words, self.first = hash_words(self.raw, PLAIN)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.window, n = window, max(0, len(doc) - window + 1)
        self.at = np.flatnonzero(doc[:n] == doc[len(doc) - n:])
        self.doc = doc[self.at]
        self.h = hash_runs(self.words, window, ODD)[self.at]

    def counters(self, row: int, total: int) -> np.ndarray:
        return mixed(self.h + np.uint64((row + 1) * int(ODD2) % (1 << 64))) % np.uint64(total)

    def repeated(self, total: int, met: list[np.ndarray]) -> np.ndarray:
        """Which windows are estimated repeated, from the answers."""
        out = np.ones(len(self.at), bool)
        bits = np.uint64(max(1, len(self.at).bit_length()))
        fits = int(bits) + (total - 1).bit_length() <= 64
        for row in range(ROWS):
            c = self.counters(row, total)
            if fits:
                # counter and place in one number: the fastest way to sort both
                v = np.sort((c << bits) | np.arange(len(self.at), dtype=np.uint64))
                c, place = v >> bits, (v & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            else:
                place = np.argsort(c, kind="stable")
                c = c[place]
            new = np.concatenate(([True], c[1:] != c[:-1]))
            nth = np.cumsum(new) - 1
            out[place] &= (met[row] | (np.diff(np.append(np.flatnonzero(new), len(c))) > 1))[nth]
        return out

    def keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For some windows: their distinct keys in order (two columns), the
        smallest id each key has here, and the key of every window."""
        a = self.h[at]
        b = hash_runs(mixed(self.words ^ ODD2), self.window, ODD2)[self.at[at]]
        new, order = _runs(a, b)
        keys = np.stack((a[order], b[order]), axis=1)[new]
        least = np.minimum.reduceat(self.ids[self.doc[at]][order], np.flatnonzero(new))
        back = np.empty(len(at), np.int64)
        back[order] = np.cumsum(new) - 1
        return keys, least, back


def _runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of a run, order) that put equal pairs (a, b) together."""
    order = np.argsort(a)
    x, y = a[order], b[order]
    if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
    return np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))), order


def _answers(table: DataFrame, folder: str) -> None:
    """Write each block's answers (part, bits) into one file."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        body = b"".join(struct.pack("<qqq", p, n, len(b)) + b for p, n, b in sorted(zip(pdf["part"], pdf["n"], pdf["bits"])))
        write_file(f"{folder}/{key[0]}.bits", [body])
        return pd.DataFrame({"block": [key[0]], "size": [len(body)]})
    table.groupBy("block").applyInPandas(run, "block long, size long").agg(F.sum("size")).first()


def _read_bits(uri: str, n: int) -> np.ndarray:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return np.unpackbits(np.frombuffer(f.read(), np.uint8), count=n).astype(bool)


def _read_answers(folder: str, block: int) -> dict[int, np.ndarray]:
    fs, path = open_fs(f"{folder}/{block}.bits")
    out, at = {}, 0
    with fs.open_input_file(path) as f:
        body = f.read()
    while at < len(body):
        part, n, size = struct.unpack_from("<qqq", body, at)
        out[part] = np.unpackbits(np.frombuffer(body, np.uint8, size, at + 24), count=n).astype(bool)
        at += 24 + size
    return out


def _met(folder: str, block: int, stretches: int) -> list[np.ndarray]:
    got = _read_answers(folder, block)
    pick = [[got[p] for p in sorted(got) if p // stretches == row] for row in range(ROWS)]
    return [np.concatenate(x) if x else np.zeros(0, bool) for x in pick]


def remove_repeats(docs: DataFrame, window: int = 13, block_words: int = 1 << 20, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) for every document."""
    spark = docs.sparkSession
    packed = staged(blocks(docs, block_words), "blocks")
    n = packed.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    folder = fresh_folder(spark, "answers")
    stretch = STRETCH                     # longer ones on a large corpus: 4096 a row at most
    while n * COUNTERS > stretch * 4096 and stretch < 1 << 26:
        stretch *= 2
    stretches = max(1, -(-n * COUNTERS // stretch))
    total, groups = stretch * stretches, max(1, -(-n // KEYS))

    # pass 1: the sketches of the blocks, merged
    def sketch(batches):
        for b in batches:
            for block, data in zip(b["block"], b["data"]):
                own = Block(data, window)
                for row in range(ROWS):
                    c = np.sort(own.counters(row, total)).astype(np.int64)
                    c = c[np.diff(c, prepend=-1) > 0]
                    cuts = np.searchsorted(c, np.arange(stretches + 1) * stretch)
                    yield pd.DataFrame([(block, row * stretches + k, hi - lo, _pack(np.diff(c[lo:hi], prepend=k * stretch).astype("<u4")))
                                        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo],
                                       columns=["block", "part", "n", "counters"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(stretch, np.uint8)
        for raw in pdf["counters"]:
            c = np.cumsum(_unpack(raw, "<u4"), dtype=np.int64)
            seen[c] = np.minimum(seen[c] + 1, 2)
        bits = [np.packbits(seen[np.cumsum(_unpack(raw, "<u4"), dtype=np.int64)] > 1).tobytes() for raw in pdf["counters"]]
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "n": pdf["n"], "bits": bits})
    answer = "block long, part long, n long, bits binary"
    _answers(packed.mapInPandas(sketch, "block long, part long, n long, counters binary")
             .groupBy("part").applyInPandas(merge, answer), f"{folder}/counters")

    # pass 2: the windows estimated repeated, grouped exactly
    edges = np.array([(i << 64) // groups for i in range(1, groups)], np.uint64)

    def candidates(batches):
        for b in batches:
            for block, data in zip(b["block"], b["data"]):
                own = Block(data, window)
                if not len(own.at):
                    continue
                again = own.repeated(total, _met(f"{folder}/counters", block, stretches))
                write_file(f"{folder}/again/{block}.bits", [np.packbits(again).tobytes()])
                if not again.any():
                    continue
                keys, least, _ = own.keys(np.flatnonzero(again))
                cuts = np.concatenate(([0], np.searchsorted(keys[:, 0], edges), [len(keys)]))
                yield pd.DataFrame([(block, k, hi - lo, keys[lo:hi].tobytes(), _pack(least[lo:hi]))
                                    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo],
                                   columns=["block", "part", "n", "keys", "least"])

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reset_index(drop=True)
        keys = np.frombuffer(b"".join(pdf["keys"]), "<u8").reshape(-1, 2)
        least = np.concatenate([_unpack(x, "<i8") for x in pdf["least"]])
        new, order = _runs(keys[:, 0], keys[:, 1])
        smallest = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        earlier = np.zeros(len(keys), bool)
        earlier[order] = smallest < least[order]
        ends = np.cumsum(pdf["n"].to_numpy())
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "n": pdf["n"], "bits": [
            np.packbits(x).tobytes() for x in np.split(earlier, ends[:-1])]})
    _answers(packed.mapInPandas(candidates, "block long, part long, n long, keys binary, least binary")
             .groupBy("part").applyInPandas(group, answer), f"{folder}/windows")

    def remove(batches):
        for b in batches:
            for block, data in zip(b["block"], b["data"]):
                own = Block(data, window)
                gone = np.zeros(int(own.first[-1]) + 1, np.int64)
                if len(own.at):
                    again = np.flatnonzero(_read_bits(f"{folder}/again/{block}.bits", len(own.at)))
                    if len(again):
                        _, least, back = own.keys(again)
                        got = _read_answers(f"{folder}/windows", block)
                        earlier = np.concatenate([got[p] for p in sorted(got)])
                        starts = own.at[again[earlier[back] | (least[back] < own.ids[own.doc[again]])]]
                        np.add.at(gone, starts, 1)
                        np.add.at(gone, starts + window, -1)
                gone = np.cumsum(gone)[:-1] > 0
                rows = []
                for d, raw in enumerate(own.raw):
                    g = gone[own.first[d]:own.first[d + 1]]
                    words = raw.split()
                    kept = b" ".join([w for w, x in zip(words, g.tolist()) if not x] if g.any() else words)
                    rows.append((None if own.null[d] else int(own.ids[d]), len(words), int(g.sum()),
                                 hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
                out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else [])])
                yield out.astype({"doc_id": "Int64"})
    return packed.mapInPandas(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string"
                              + (", kept string" if with_text else ""))
