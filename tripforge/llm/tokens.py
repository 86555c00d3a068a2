"""Token ids in rANS files that decode in parallel.

Documents are put into ascending ``doc_id`` order (nulls first; equal ids by
text), encoded by a public tokenizer, and closed with an end id.  The ids are
coded by a static range asymmetric numeral system: one frequency table, counted
over the whole corpus, serves all files.  A file is a row of independent blocks
of ``BLOCK`` ids; a block interleaves ``LANES`` coder states over one stream of
32-bit words.  The footer holds a checkpoint for every block (byte offset, ids,
words, CRC-32 of the block) and the table of documents, so blocks decode alone
and in any order; a batch of blocks is coded in lockstep with numpy.

File: b"TKR1", blocks, footer (block table, documents), footer length, CRC-32 of
the footer, b"TKR1".  Block: LANES 64-bit states, then the words.

Null and blank-free empty texts have the end id alone.  Repeated rows are kept,
each with its own ids.  An empty table makes no files and gives no rows.  Extra
columns are ignored.

The texts move once (range partitions by id, sorted and spillable), the ids are
staged once, and all later steps read them in file order without a shuffle.  A
task holds one batch of blocks, or some texts and a bounded memory of words, at a
time.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripforge.llm.common import fresh_folder, give_back, open_fs, small_batches, spread, staged, text_of, write_file

MAGIC = b"TKR1"
LANES, BLOCK = 32, 1 << 15
BATCH = 64                       # blocks coded in lockstep
SCALE = 20                       # the frequencies add up to 2 ** SCALE
LOW = np.uint64(1 << 31)         # states stay in [2 ** 31, 2 ** 63)
U32 = np.uint64(32)

PIECE = 1 << 18                  # characters that go to the tokenizers library at a time
CHUNK = 1 << 22                  # bytes of texts that are taken apart at a time
KEEP = 200_000                   # words that a worker remembers in a generation, of two
GROUP = 128                      # words that go to the BPE model as one
LONGEST = 64                     # bytes of a word that is remembered
# A word of byte-level BPE always begins with a space that a letter or digit follows.
WORD_START = re.compile(" [A-Za-z0-9]")

# Kinds of bytes.  Letters are those of ASCII and of two bytes up to U+023F, of which
# every version of Unicode says the same; all that is not listed here is odd.
LETTER, DIGIT, SIGN, SPACE, BLANK, ODD, MIDDLE = range(1, 8)


def _kinds() -> np.ndarray:
    out = np.full(256, ODD, np.uint8)
    out[33:127] = SIGN
    out[[ord("'"), *b" \t\n\r"]] = [ODD, SPACE, BLANK, BLANK, BLANK]     # 's and the like are words
    out[list(range(48, 58))] = DIGIT
    out[[*range(65, 91), *range(97, 123), *range(0xC3, 0xC9)]] = LETTER
    out[0x80:0xC0] = MIDDLE
    return out


KINDS = _kinds()


def _mapped(a: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[a]`` of bytes; numpy would make eight bytes of each to look it up."""
    return np.frombuffer(bytearray(a.tobytes().translate(table.tobytes())), table.dtype)


# White space beyond ASCII: the first bytes of its characters.
WHITE = np.array([0xC28500, 0xC2A000, 0xE19A80, 0xE1A08E, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF,
                  0xE2819F, 0xE38080])


def kinds_of(text: np.ndarray) -> np.ndarray:
    """The kind of every byte of UTF-8."""
    out = _mapped(text, KINDS)
    high = np.flatnonzero(text >= 0x80)
    if len(high):
        b, before, after = text[high], text[high - 1], text[np.minimum(high + 1, len(text) - 1)]
        inside = (b & 0xC0) == 0x80
        lead, last = np.where(inside, before, b), np.where(inside, b, after)
        letter = (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))     # no ×, ÷
        out[high] = np.where(letter, LETTER, ODD)
    return out


def _turns() -> np.ndarray:
    """Does a byte of kind k after one of kind p begin a word, by k * 8 + p?  White space
    in front of a word is looked at apart."""
    out = np.zeros((32, 8), bool)
    for k in range(8):
        for p in range(8):
            out[k, p] = k != p and p != SPACE and not (k == SPACE and p == BLANK)
    return out.ravel()


TURNS = _turns()


def words_at(text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the words of byte-level BPE begin in texts that lie one after the other
    (``first``: the first byte of each that is not empty).

    Words are runs of letters, of digits or of signs, each with the one space before
    it.  Of a run of white space before a word the last character stands apart (or is
    that space).  What is between two spaces that begin a word is left whole if it
    holds an odd byte."""
    n, kind = len(text), kinds_of(text)
    odd = np.flatnonzero(kind == ODD)
    solid = (kind != SPACE) & (kind != BLANK)            # no white space, to the right
    if len(odd):
        b = text[odd]
        solid[odd[b < 32]] = False
        at = odd[(b == 0xC2) | ((b >= 0xE1) & (b <= 0xE3))]
        code = (text[at].astype(np.int64) << 16) + (text[np.minimum(at + 1, n - 1)].astype(np.int64) << 8)
        code += np.where(text[at] == 0xC2, 0, text[np.minimum(at + 2, n - 1)])
        solid[at[np.isin(code, WHITE)]] = False
    solid[first] = False                                 # of the next text
    white = np.flatnonzero((kind[:-1] == SPACE) | (kind[:-1] == BLANK))
    white = white[solid[white + 1]]                      # the last character before a word
    begins = np.zeros(n, bool)
    begins[1:] = _mapped((kind[1:] << 3) | kind[:-1], TURNS)
    begins[white] = True
    begins[first] = True
    if len(odd):
        hard = np.union1d(first, white[kind[white] == SPACE])
        piece = np.unique(np.searchsorted(hard, odd, side="right") - 1)
        step = np.zeros(n + 1, np.int8)
        step[hard[piece]] += 1
        step[np.append(hard, n)[piece + 1]] -= 1
        begins &= ~np.cumsum(step[:-1], dtype=np.int8).view(bool)
        begins[hard] = True
    return np.flatnonzero(begins)


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level BPE writes for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(rest)}


BYTES = _byte_letters()
LETTERS = np.array([BYTES[b] for b in range(256)], "<u4")
MARK = 0                         # a byte that is odd: it stands between words, as a token of its own


def _binary(ends: np.ndarray, data) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(data)])


def _bytes_of(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ends, bytes) of a large string or binary array."""
    ends = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return ends - ends[0], data


# A number for each byte at each place of a word; a word's hash is their sum.
PLACED = np.random.default_rng(8).integers(0, 1 << 64, LONGEST << 8, np.uint64)


def hashes_of(words: pa.LargeBinaryArray) -> np.ndarray:
    """64-bit hashes of words (none is empty); those over LONGEST bytes, which are not remembered, have 0."""
    ends, data = _bytes_of(words)
    out = np.zeros(len(words), np.uint64)
    for k in range(0, len(words), 1 << 14):
        e = ends[k:k + (1 << 14) + 1]
        n = np.diff(e)
        short = n <= LONGEST
        part = data[e[0]:e[-1]]
        if not short.all():
            part = part[np.repeat(short, n)]
        n = n[short]
        if len(n):
            first = np.cumsum(n) - n
            at = np.arange(len(part)) - np.repeat(first, n)
            out[k:k + (1 << 14)][short] = np.add.reduceat(PLACED[(at << 8) + part], first)
    return out


# -- tokenizing -----------------------------------------------------------------------
def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to little-endian ids by the tokenizers library.

    Byte-level BPE encodes every word by itself, so a text's ids are those of its
    words, one after the other: ``words_at`` finds them in a chunk's bytes, Arrow
    numbers the distinct ones and puts their ids together.  The words met of late
    are remembered in Arrow arrays (two generations of ``keep``: the older one goes
    when the younger is full, and what is met again moves up) and found by their
    hashes, and only others go to the library: plain words to its BPE model past the
    rules that look for words' ends, by groups, parted by a token that no plain word
    holds, what holds odd bytes whole.  A text with a special token's string goes to the library itself, in
    pieces of about ``piece`` characters, since the library keeps many times a
    text's size.  Tokenizers of another kind get every text whole."""

    def __init__(self, path: str, piece: int = PIECE, keep: int = KEEP):
        # Spark runs a task on every core; threads of the library's own would contend with them
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.piece, self.keep = Tokenizer.from_file(path), piece, keep
        conf = json.loads(self.tok.to_str())
        pre, added = conf.get("pre_tokenizer") or {}, conf.get("added_tokens", [])
        mark = chr(BYTES[MARK])
        self.mark = self.tok.token_to_id(mark)
        self.by_word = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                        and pre.get("use_regex", True) and conf.get("normalizer") is None
                        and conf["model"]["type"] == "BPE" and not conf["model"].get("dropout") and self.mark is not None
                        and not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in added))
        self.special = [t["content"] for t in added]
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.words = Tokenizer(self.tok.model)
        model = conf["model"]
        if (model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
                or any(mark in w for w in self.tok.get_vocab() if w != mark)):
            self.words.pre_tokenizer = pre_tokenizers.Split(mark, "isolated")
        # words, their hashes and their ids: the younger generation, then the older one
        self.known = self.ids = pa.array([], pa.large_binary())
        self.hashes = np.zeros(0, np.uint64)
        self.young = 0

    def _library(self, texts: list[str], tok=None) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in (tok or self.tok).encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> list[str]:
        at, out = 0, []
        while self.by_word and len(text) - at > self.piece and (m := WORD_START.search(text, at + self.piece)):
            out.append(text[at:m.start()])
            at = m.start()
        return out + [text[at:]]

    def _code(self, words: pa.LargeBinaryArray) -> list[pa.LargeBinaryArray]:
        """The ids of plain words.  No merge holds the mark, so that none reaches over it:
        the model gets groups of words at once, or splits them if its tokens depend on where
        a word ends."""
        out, dtype = [], self.dtype
        for k in range(0, len(words), 40 * GROUP):
            ends, data = _bytes_of(words.slice(k, 40 * GROUP))
            n = len(ends) - 1
            raw = LETTERS[np.insert(data, ends[:-1], MARK)].tobytes()
            cuts = 4 * (ends + np.arange(n + 1))[np.append(np.arange(0, n, GROUP), n)]
            ids = np.concatenate(self._library([raw[a:b].decode("utf-32-le") for a, b in zip(cuts, cuts[1:])], self.words))
            mark = ids == self.mark
            at = np.flatnonzero(mark)
            if len(at) != n:
                raise ValueError("the tokenizer does not keep words apart as byte-level BPE does")
            out.append(_binary(np.append(at - np.arange(n), len(ids) - n) * dtype.itemsize, ids[~mark]))
        return out

    def _code_odd(self, words: pa.LargeBinaryArray) -> list[pa.LargeBinaryArray]:
        out, some, size = [], [], 0
        for w in [*words.to_pylist(), None]:
            if some and (w is None or size >= self.piece):
                out.append(pa.array([x.tobytes() for x in self._library(some)], pa.large_binary()))
                some, size = [], 0
            if w is not None:
                some.append(w.decode())
                size += len(w)
        return out

    def _find(self, words: pa.LargeBinaryArray, hashes: np.ndarray) -> np.ndarray:
        """The place of every word in ``known``, or -1."""
        place = np.full(len(words), -1)
        if len(self.known):
            order, turn = np.argsort(self.hashes), np.argsort(hashes)      # sorted on both sides: looked up much faster
            at = np.empty(len(words), np.int64)
            at[turn] = np.searchsorted(self.hashes[order], hashes[turn])
            at = order[np.minimum(at, len(order) - 1)]
            hit = np.flatnonzero(self.hashes[at] == hashes)
            same = pc.equal(self.known.take(pa.array(at[hit])), words.take(pa.array(hit))).to_numpy(zero_copy_only=False)
            place[hit[same]] = at[hit[same]]
        return place

    def _learn(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The ids of these words (distinct)."""
        if self.young > self.keep:
            self.known, self.ids = self.known.slice(0, self.young), self.ids.slice(0, self.young)
            self.hashes, self.young = self.hashes[:self.young], 0
        hashes = hashes_of(words)
        place = self._find(words, hashes)
        fresh = np.flatnonzero(place < 0)
        new = words.take(pa.array(fresh))
        ends, data = _bytes_of(new)
        odd = np.logical_or.reduceat(kinds_of(data) == ODD, ends[:-1]) if len(new) else np.zeros(0, bool)
        plain = np.flatnonzero(~odd)
        coded = [*self._code(new.take(pa.array(plain))), *self._code_odd(new.take(pa.array(np.flatnonzero(odd))))]
        place[fresh[plain]] = len(self.ids) + np.arange(len(plain))
        place[fresh[odd]] = len(self.ids) + len(plain) + np.arange(len(fresh) - len(plain))
        ids = pa.concat_arrays([self.ids, *coded]).take(pa.array(place))
        up = np.flatnonzero((place >= self.young) & (pc.binary_length(words).to_numpy() <= LONGEST))
        rest = np.arange(len(self.known)) >= self.young  # of the older generation, less what moves up
        rest[place[place < len(rest)]] = False
        rest = np.flatnonzero(rest)
        self.known, self.ids = (pa.concat_arrays([a.slice(0, self.young), b.take(pa.array(up)), a.take(pa.array(rest))])
                                for a, b in ((self.known, words), (self.ids, ids)))
        self.hashes = np.concatenate((self.hashes[:self.young], hashes[up], self.hashes[rest]))
        self.young += len(up)
        return ids

    def _plain(self, texts: pa.LargeStringArray, end: bytes) -> pa.LargeBinaryArray:
        bounds, data = _bytes_of(texts)
        first = bounds[:-1][np.diff(bounds) > 0]
        at = words_at(data, first) if len(data) else np.zeros(0, np.int64)
        coded = _binary(np.append(at, len(data)), data).dictionary_encode()
        ids = self._learn(coded.dictionary)
        stop = np.searchsorted(at, bounds[1:])           # words up to each text's end
        place = np.insert(coded.indices.to_numpy(), stop, len(ids))
        ends, raw = _bytes_of(pa.concat_arrays([ids, pa.array([end], pa.large_binary())]).take(pa.array(place)))
        return _binary(ends[np.append(0, stop + np.arange(1, len(stop) + 1))], raw)

    def encode_array(self, texts: pa.LargeStringArray, end: bytes = b"") -> pa.LargeBinaryArray:
        """The ids of every text, each followed by ``end``."""
        whole = np.full(len(texts), not self.by_word)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._plain(texts, end)
        plain = self._plain(texts.filter(pa.array(~whole)), end)
        rest = [b"".join(self._library([p])[0].tobytes() for p in self._cut(t)) + end
                for t in texts.filter(pa.array(whole)).to_pylist()]
        order = np.empty(len(texts), np.int64)
        order[np.append(np.flatnonzero(~whole), np.flatnonzero(whole))] = np.arange(len(texts))
        return pa.concat_arrays([plain, pa.array(rest, pa.large_binary())]).take(pa.array(order))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.large_string())).to_pylist()


_ENCODERS: dict[str, Encoder] = {}


def tokenized(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """(part, seq, doc_id, n, width, ids, seen): documents in order, ids with the end id, and after
    those of a partition a row with ``seen``: how often each id occurs in it (8 bytes for each)."""
    path = tokenizer or default_tokenizer()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // (128 << 20)))
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                        ("width", pa.int32()), ("ids", pa.binary()), ("seen", pa.binary())])

    def run(batches):
        enc = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        part, seq, width, seen = TaskContext.get().partitionId(), 0, enc.dtype.itemsize, np.zeros(0, np.int64)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            texts = b.column("text").cast(pa.large_string())
            sizes, at = np.cumsum(pc.binary_length(texts).to_numpy()), 0
            while at < len(texts):            # some millions of bytes at a time
                to = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK)) + 1
                ids = enc.encode_array(texts.slice(at, to - at), end)
                n, c = len(ids), np.bincount(_bytes_of(ids)[1].view(enc.dtype), minlength=len(seen))
                c[:len(seen)] += seen
                seen = c
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), b.column("doc_id").slice(at, n),
                    pc.divide(pc.binary_length(ids), width), pa.array(np.full(n, width, np.int32)), ids.cast(pa.binary()),
                    pa.nulls(n, pa.binary())], schema=schema)
                seq, at, ids = seq + n, at + n, None
                give_back()
        if seq:
            yield pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "seen": seen.astype("<i8").tobytes()}], schema)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).repartitionByRange(
        parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part int, seq long, doc_id long, n long, width int, ids binary, seen binary")


def counts(tokens: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs in the whole corpus."""
    def run(batches):
        for b in batches:
            for raw in b.column("seen"):
                n = np.frombuffer(raw.as_buffer(), "<i8")
                ids = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[ids])], ["id", "n"])
    return tokens.select("seen").where("seen IS NOT NULL").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


# -- coding -----------------------------------------------------------------------
@dataclass
class Table:
    """Frequencies that add up to 2 ** SCALE, one at least for each id seen."""

    freq: np.ndarray

    def __post_init__(self):
        self.freq = self.freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self._slots = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    @classmethod
    def fit(cls, ids: np.ndarray, n: np.ndarray) -> "Table":
        if len(ids) > 1 << (SCALE - 1):
            raise ValueError("more ids in use than the table has room for")
        f = np.maximum(1, np.floor(n * ((1 << SCALE) / n.sum()))).astype(np.int64)
        gap, by_size = (1 << SCALE) - int(f.sum()), np.argsort(-f, kind="stable")
        if gap > 0:
            f[by_size[0]] += gap
        for i in by_size:                     # too many ones: taken back from the largest
            if gap >= 0:
                break
            cut = min(-gap, int(f[i]) // 2)
            f[i] -= cut
            gap += cut
        full = np.zeros(int(ids.max()) + 1, np.int64)
        full[ids] = f
        return cls(full)


def encode_blocks(table: Table, ids: np.ndarray) -> list[bytes]:
    """Blocks of BLOCK ids (the last may be shorter), coded in lockstep."""
    n_blocks = -(-len(ids) // BLOCK)
    steps = min(BLOCK, len(ids) + LANES - 1) // LANES if n_blocks == 1 else BLOCK // LANES
    grid = np.zeros(n_blocks * BLOCK, ids.dtype)
    grid[:len(ids)] = ids
    grid = grid.reshape(n_blocks, BLOCK // LANES, LANES)[:, :steps].swapaxes(0, 1).reshape(steps, -1)
    size = np.full(n_blocks, BLOCK)
    size[-1] = len(ids) - BLOCK * (n_blocks - 1)
    x = np.full(n_blocks * LANES, LOW, np.uint64)
    words = np.zeros((steps, n_blocks * LANES), np.uint32)      # the low half of every state
    put = np.zeros(words.shape, bool)                           # does it go into the stream?
    lane, full = np.arange(LANES), int(size.min()) // LANES     # every lane is in use up to there
    rest, shift = np.uint64(1 << SCALE) - table.freq, np.uint64(63 - SCALE)
    for k in range(steps - 1, -1, -1):
        s, out = grid[k], put[k]
        f = table.freq[s]
        np.greater_equal(x >> shift, f, out=out)
        if k >= full:
            live = ((k * LANES + lane)[None, :] < size[:, None]).ravel()
            f = np.where(live, f, np.uint64(1))
            out &= live
        words[k] = x
        y = x >> (out * U32)
        y += y // f * rest[s] + table.start[s]                  # (y // f << SCALE) + y % f + start
        x = y if k < full else np.where(live, y, x)
    x, words, put = x.reshape(n_blocks, LANES), words.reshape(steps, n_blocks, LANES), put.reshape(steps, n_blocks, LANES)
    return [x[i].astype("<u8").tobytes() + words[:, i][put[:, i]].astype("<u4").tobytes() for i in range(n_blocks)]


def decode_blocks(table: Table, blocks: list[bytes], sizes: list[int]) -> np.ndarray:
    """The ids of some blocks, one after the other; any choice of blocks will do."""
    x = np.concatenate([np.frombuffer(b, "<u8", LANES) for b in blocks]).astype(np.uint64)
    streams = [np.frombuffer(b, "<u4", offset=8 * LANES) for b in blocks]
    words = np.concatenate(streams)
    at = np.concatenate(([0], np.cumsum([len(s) for s in streams])[:-1])).astype(np.int64)
    size, lane = np.array(sizes), np.arange(LANES)
    steps, full = -(-int(size.max()) // LANES), int(size.min()) // LANES
    out = np.zeros((steps, len(blocks) * LANES), np.uint32)
    mask, slots, edges = np.uint64((1 << SCALE) - 1), table.slots, np.arange(len(blocks) + 1) * LANES
    for k in range(steps):
        slot = x & mask
        s = out[k] = slots[slot.view(np.int64)]
        y = table.freq[s] * (x >> np.uint64(SCALE)) + slot - table.start[s]
        need = y < LOW
        if k >= full:
            live = ((k * LANES + lane)[None, :] < size[:, None]).ravel()
            y, need = np.where(live, y, x), need & live
        x, need = y, np.flatnonzero(need)
        first = np.searchsorted(need, edges)                    # of each block
        n = np.diff(first)
        x[need] = (x[need] << U32) | words[np.arange(len(need)) + np.repeat(at - first[:-1], n)]
        at += n
    flat = out.reshape(steps, len(blocks), LANES)
    return np.concatenate([flat[:, i].ravel()[:n] for i, n in enumerate(sizes)])


# -- files -----------------------------------------------------------------------
INDEX = "file string, part int, seq long, n_docs long, n_tokens long, bytes long"
ENTRY = struct.Struct("<QIII")


def table_file(table: Table) -> bytes:
    body = zstandard.compress(table.freq.astype("<u4").tobytes())
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def read_table(uri: str) -> Table:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        raw = f.read()
    if raw[:4] != MAGIC or zlib.crc32(raw[8:]) != struct.unpack("<I", raw[4:8])[0]:
        raise ValueError(f"{uri} is no frequency table, or damaged")
    return Table(np.frombuffer(zstandard.decompress(raw[8:]), "<u4"))


def footer(entries: list[tuple], doc_ids: list, sizes: list[int]) -> bytes:
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    null = np.packbits(np.array([d is None for d in doc_ids], bool)).tobytes()
    docs = zstandard.compress(ids + np.array(sizes, "<u8").tobytes() + null)
    body = struct.pack("<II", len(entries), len(doc_ids)) + b"".join(ENTRY.pack(*e) for e in entries) + docs
    return body + struct.pack("<II", len(body), zlib.crc32(body)) + MAGIC


def read_footer(f) -> tuple[list[tuple], list, np.ndarray]:
    """(checkpoints, doc_ids, their numbers of ids) of an open file."""
    end = f.size()
    f.seek(end - 12)
    length, crc = struct.unpack("<II", f.read(8))
    if f.read(4) != MAGIC:
        raise ValueError("no token file")
    f.seek(end - 12 - length)
    body = f.read(length)
    if zlib.crc32(body) != crc:
        raise ValueError("the footer is damaged")
    n_blocks, n = struct.unpack_from("<II", body)
    entries = list(ENTRY.iter_unpack(body[8:8 + ENTRY.size * n_blocks]))
    docs = zstandard.decompress(body[8 + ENTRY.size * n_blocks:])
    null = np.unpackbits(np.frombuffer(docs[16 * n:], np.uint8), count=n).astype(bool)
    ids = [None if z else int(i) for i, z in zip(np.frombuffer(docs, "<i8", n), null)]
    return entries, ids, np.frombuffer(docs, "<u8", n, 8 * n).astype(np.int64)


def read_blocks(f, table: Table, entries: list[tuple]) -> np.ndarray:
    """The ids of the blocks at some checkpoints, each held against its checksum."""
    blocks = []
    for offset, _, n_words, crc in entries:
        f.seek(offset)
        b = f.read(8 * LANES + 4 * n_words)
        if zlib.crc32(b) != crc:
            raise ValueError(f"the block at {offset} is damaged")
        blocks.append(b)
    return decode_blocks(table, blocks, [e[1] for e in entries])


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                      end_id: int = 0, file_tokens: int = 1 << 25) -> tuple[DataFrame, str]:
    """Write the files; returns their index (one row per file) and the folder."""
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "token-files")
    with small_batches(spark, CHUNK):
        tokens = staged(tokenized(docs, tokenizer, end_id), "ids")
        seen = counts(tokens).orderBy("id").toPandas()  # a row per id of the vocabulary
    if seen.empty:
        return spark.createDataFrame([], INDEX), folder
    table = Table.fit(seen["id"].to_numpy(), seen["n"].to_numpy())
    write_file(f"{folder}/table.bin", [table_file(table)])

    def run(batches):
        name = part = None
        chunks, entries, doc_ids, sizes, todo, first, seq, offset, waiting = [], [], [], [], [], 0, -1, 4, 0

        def code(all_of_it: bool):
            nonlocal todo, offset, waiting
            ids = np.concatenate(todo) if todo else np.zeros(0, np.int64)
            upto = len(ids) if all_of_it else len(ids) // BLOCK * BLOCK
            for k in range(0, upto, BATCH * BLOCK):
                piece = ids[k:min(k + BATCH * BLOCK, upto)]
                for j, b in enumerate(encode_blocks(table, piece)):
                    entries.append((offset, min(BLOCK, len(piece) - j * BLOCK), (len(b) - 8 * LANES) // 4, zlib.crc32(b)))
                    chunks.append(b)
                    offset += len(b)
            todo, waiting = [ids[upto:]], len(ids) - upto

        def close():
            nonlocal name, chunks, entries, doc_ids, sizes, todo, offset, waiting
            code(True)
            size = write_file(f"{folder}/{name}", [MAGIC, *chunks, footer(entries, doc_ids, sizes)])
            row = pd.DataFrame([(f"{folder}/{name}", part, first, len(doc_ids), sum(sizes), size)],
                               columns=["file", "part", "seq", "n_docs", "n_tokens", "bytes"])
            name, chunks, entries, doc_ids, sizes, todo, offset, waiting = None, [], [], [], [], [], 4, 0
            return row
        for b in batches:
            cols = (b[c].tolist() for c in ("part", "seq", "doc_id", "n", "width", "ids"))
            for p, q, d, n, width, raw in zip(*cols):
                if name and (p != part or q != seq + 1 or sum(e[1] for e in entries) >= file_tokens):
                    yield close()
                if not name:
                    name, part, first = f"{uuid.uuid4().hex}.tkr", p, q
                seq = q
                doc_ids.append(None if pd.isna(d) else int(d))
                sizes.append(n)
                todo.append(np.frombuffer(raw, f"<u{width}"))
                waiting += n
                if waiting >= BATCH * BLOCK:
                    code(False)
        if name:
            yield close()
        give_back()

    rows = tokens.where("seen IS NULL").drop("seen")
    with small_batches(spark):
        return staged(rows.mapInPandas(run, INDEX), "token-index"), folder


def read_token_files(spark: SparkSession, index: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from
    the files; ``start`` counts the ids of all documents before it."""
    placed = index.select("file", (F.sum("n_tokens").over(Window.orderBy("part", "seq")) - F.col("n_tokens")).alias("start"))

    def run(batches):
        table = None
        for b in batches:
            for uri, start in zip(b["file"], b["start"]):
                table = table or read_table(f"{folder}/table.bin")
                fs, path = open_fs(uri)
                with fs.open_input_file(path) as f:
                    entries, doc_ids, sizes = read_footer(f)
                    ends = np.cumsum(sizes)
                    base, rest, doc = 0, np.zeros(0, "<u4"), 0
                    for k in range(0, len(entries), BATCH):
                        got = np.concatenate((rest, read_blocks(f, table, entries[k:k + BATCH]).astype("<u4")))
                        to = int(np.searchsorted(ends, base + len(got), side="right"))
                        pieces = np.split(got, ends[doc:to] - base)
                        out = pd.DataFrame({
                            "doc_id": pd.array(doc_ids[doc:to], "Int64"),
                            "start": (start + ends[doc:to] - sizes[doc:to]).astype(np.int64), "n_tokens": sizes[doc:to],
                            "ids_crc32": np.array([zlib.crc32(p.tobytes()) for p in pieces[:-1]], np.int64)})
                        if with_ids:
                            out["ids"] = [p.astype(np.int64) for p in pieces[:-1]]
                        base, rest, doc = base + len(got) - len(pieces[-1]), pieces[-1], to
                        yield out
        give_back()
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return spread(placed).mapInPandas(run, schema)
