"""Cases that once went wrong: rows by place, counters, base spans, closing marks."""
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tripforge.llm import common as C
from tripforge.llm import decontaminate as D
from tripforge.llm import mixing as M
from tripforge.llm import quality as Q
from tripforge.llm import secrets as S
from tripforge.llm import simhash as H
from tripforge.llm import substrings as B
from tripforge.llm import tokens
from tripforge.session import scratch_path


def test_rows_are_told_apart_by_their_place(spark, odd, no_documents):
    """Straight from files, from files after a filter, and from no files; the set's bits find each row."""
    path = scratch_path(spark, "t e%st")
    spark.range(100_000).select(F.col("id"), (F.col("id") * 7 % 11).alias("x")).repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    for df in (table, table.filter("x <> 3"), spark.range(500).withColumn("x", F.lit(1)), odd, no_documents):
        rows = C.staged(C.numbered(df), "told")
        assert rows.count() == df.count() == rows.select("__row").distinct().count()
    rows = C.numbered(table)
    again = C.numbered(spark.read.parquet(path))
    assert rows.exceptAll(again).count() == 0                        # the same whenever they are read
    bits = C.staged(C.bits_of(rows.filter("x = 5 OR id < 3").select("__row")), "bits")
    got = C.marked(rows, bits, "hit")
    assert got.filter("hit <> (x = 5 OR id < 3)").count() == 0 and got.count() == 100_000
    assert C.marked(rows, bits.limit(0), "hit").filter("hit").count() == 0


def test_stages_move_no_text(spark):
    """Near-dedup, decontamination and mix join bits and small tables only: no exchange holds texts."""
    path = scratch_path(spark, "plain")
    docs = spark.createDataFrame([(i, f"word{i} " * 40, f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    docs.repartition(2).write.parquet(path)
    docs = spark.read.parquet(path)
    bench = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(30)))], "item_id long, text string")
    for out in (H.keep_one(docs), D.keep_clean(docs, bench), M.mixed_documents(docs)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in re.findall(r"Exchange hashpartitioning[^\n]*", plan)]
        assert "BroadcastHashJoin" in plan and not moved
        assert out.columns == docs.columns


def test_mix_takes_what_the_plan_says(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(1 + i % 9)), f"s{i % 4}") for i in range(400)]
                                 + [(5, "same id other text", "s1"), (None, "no id here", None), (7, None, "s3"), (8, " ", "s0")],
                                 "doc_id long, text string, source string")
    path = scratch_path(spark, "mix")
    docs.repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    out = M.mixed_documents(docs)
    words = F.size(C.words_of(C.text_of()))
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    want = {r.source: r.n for r in M.mix_plan(C.numbered(docs), key="__row", order_by="doc_id").groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert got == {s: n for s, n in want.items() if n}
    rerun = M.mixed_documents(docs)
    assert out.exceptAll(rerun).count() == 0 and rerun.exceptAll(out).count() == 0


def test_windows_are_found_with_any_number_of_counters(spark):
    text = " ".join(f"w{i % 700}" for i in range(3000))              # every window occurs again
    data = B.blocks(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().data
    block = B.Block(bytes(data), 13)
    for total in (1 << 20, 1 << 43, 1 << 50, 1 << 62):
        met = [np.zeros(len(np.unique(block.counters(r, total))), bool) for r in range(B.ROWS)]
        assert block.repeated(total, met).all()
    once = B.Block(bytes(B.blocks(spark.createDataFrame([(1, " ".join(f"u{i}" for i in range(3000)))], "doc_id long, text string"))
                         .first().data), 13)
    met = [np.zeros(len(np.unique(once.counters(r, 1 << 50))), bool) for r in range(B.ROWS)]
    assert not once.repeated(1 << 50, met).any()


def test_no_span_lies_on_a_base_span_however_many_there_are():
    g = S.fit({"hex": [f"{i * 7919:024x}" for i in range(200)]}, ["ordinary", "wording", "sentences", "plainly"] * 10)
    text = ".".join(f"{i * 104729 + 5:032x}" for i in range(1, 40)) + " and 0f" + f"{12345678901234567890:x}"
    base = S.base_spans(text)
    assert len(base) >= 39
    for a, z in S.Scorer(g).spans(text, base):
        assert not any(s < z and a < e for s, _, e in base)


def test_sample_of_labelled_values_is_the_smallest_hashes(spark):
    docs = spark.createDataFrame([(i, f"key password={'v%05d' % i}abc") for i in range(900)], "doc_id long, text string")
    by, _ = S.labelled(docs, sample=50)
    want = (docs.select(F.concat(F.regexp_extract("text", "=(.*)", 1)).alias("value"))
            .orderBy(F.xxhash64(F.lit(17), "value")).limit(50).collect())
    assert set(by["assign"]) == {r.value for r in want}


def test_closing_marks_before_any_white_space(spark):
    lines = ["It works." + " " * k for k in (0, 1, 9, 200)] + ["It works.\"\"\"\"\"\"\"\"\"\"" + "\t" * 12, "It works", "\"\"\"", "It works .\" \"", "Ja!»  "]
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    got = [r.c for r in df.select(Q._closed(F.col("l")).alias("c")).collect()]
    assert got == [re.search(Q.CLOSED, x) is not None for x in lines]
    body = "\n".join(f"Sentence{i} number{i} tells{i} about{i} topic {i * 7} plainly{i}." for i in range(12))
    kept = Q.quality_signals(spark.createDataFrame([(1, body + "\nIt works." + " " * 9)], "doc_id long, text string")).first()
    assert kept.lost_words == 0


def test_words_met_in_other_pieces_are_not_encoded_again():
    enc = tokens.Encoder(tokens.default_tokenizer())
    sent, library = [], enc._library
    enc._library = lambda texts, *a: sent.extend(texts) or library(texts, *a)
    enc.encode(["one (two) three-four\n\nfive"])
    n = len(sent)
    got = enc.encode(["one three-four (two)\n\nfive", ""])
    assert n and len(sent) == n
    assert got == tokens.Encoder(tokens.default_tokenizer()).encode(["one three-four (two)\n\nfive", ""])


def test_words_are_found_as_the_library_finds_them():
    from tokenizers import Tokenizer
    tok, rng = Tokenizer.from_file(tokens.default_tokenizer()), np.random.default_rng(11)
    signs = ["a", "bc", "é", "Ā", "ȿ", "ɀ", "×", "÷", "1", "²", ".", ",", "'s", "’", " ", " ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x00",
             "\x7f", "\x85", "\xa0", " ", "᠎", " ", "​", " ", "　", "日", "\U0001f600", "é", "_", "<|endoftext|>"]
    texts = ["".join(rng.choice(rng.choice(signs, 6), rng.integers(0, 25))) for _ in range(2000)] + ["", "日本語" * 200]
    enc = tokens.Encoder(tokens.default_tokenizer(), 50, 100)
    want = [np.array(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [x for k in range(0, len(texts), 50) for x in enc.encode(texts[k:k + 50])] == want
    assert pc.max(pc.binary_length(enc.known)).as_py() <= tokens.LONGEST


def test_what_an_encoder_remembers_is_bounded():
    """By words and by bytes: long pieces without a space are not kept."""
    enc = tokens.Encoder(tokens.default_tokenizer(), keep=1000)
    rng = np.random.default_rng(3)
    for _ in range(8):
        words = ["".join(map(chr, w)) for w in rng.integers(97, 123, (900, 6))]
        enc.encode([" ".join(words) + " " + "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 50_000)))])
        assert enc.young <= 2000 and len(enc.known) <= 4000
        assert enc.known.nbytes + enc.ids.nbytes < 200_000


def test_workers_get_texts_in_small_batches(spark):
    """Texts of 24 MB in one partition reach the Python stages by about 4 MB, and the setting is put back."""
    key, docs = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(0, 240, 1, 1).selectExpr(
        "id AS doc_id", "repeat(concat('w', id, ' '), 20000) AS text")
    old = spark.conf.get(key)

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"size": [int(b["text"].str.len().sum())]})
    with C.small_batches(spark):
        seen = [r[0] for r in docs.mapInPandas(sizes, "size long").collect()]
    assert len(seen) > 4 and max(seen) < 5 << 20 and spark.conf.get(key) == old
    try:
        with C.small_batches(spark):
            raise KeyError
    except KeyError:
        assert spark.conf.get(key) == old


def test_text_stages_ask_for_small_batches(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five six")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    for module in (tokens, H, D):
        def spy(df, name, real=module.staged):
            seen[name] = spark.conf.get(key)
            return real(df, name)
        monkeypatch.setattr(module, "staged", spy)
    tokens.write_token_files(docs)
    H.keep_one(docs, shingle=3, radius=2)
    D.keep_clean(docs, items)
    assert [seen[n] for n in ("ids", "token-index", "fingerprints", "hits")] == [str(1 << 22)] * 4


def test_words_and_blocks_take_few_bytes_for_each():
    """Bytes are looked up without eight bytes for each, ids are coded in the width they come in."""
    text = np.frombuffer(b"one two, three 45\n" * 60_000, np.uint8)
    table = tokens.Table(np.full(1 << 10, 1 << 10))
    ids = np.arange(8 * tokens.BLOCK, dtype="<u2") % 1024
    want = tokens.encode_blocks(table, ids.astype(np.int64))
    tracemalloc.start()
    kinds = tokens.kinds_of(text)
    assert tracemalloc.get_traced_memory()[1] < 6 * len(text)
    tracemalloc.reset_peak()
    assert tokens.encode_blocks(table, ids) == want
    blocks = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    tokens.encode_blocks(table, ids.astype(np.int64))
    assert tracemalloc.get_traced_memory()[1] > blocks + 4 * len(ids)
    tracemalloc.stop()
    assert np.array_equal(kinds, tokens.KINDS[text])


def test_new_words_go_to_the_model_by_groups():
    """Not split into one piece for every word and every mark; nothing merges over a mark."""
    from tokenizers import Tokenizer
    enc, sent, rng = tokens.Encoder(tokens.default_tokenizer()), [], np.random.default_rng(5)
    assert enc.words.pre_tokenizer is None
    library = enc._library
    enc._library = lambda texts, *a: sent.extend(texts) or library(texts, *a)
    words = sorted({"".join(map(chr, rng.integers(97, 123, rng.integers(1, 12)))) for _ in range(1000)})
    want = Tokenizer.from_file(tokens.default_tokenizer()).encode(" ".join(words), add_special_tokens=False).ids
    assert enc.encode([" ".join(words)]) == [np.array(want, "<u2").tobytes()]
    assert len(sent) == -(-len(words) // tokens.GROUP)


@pytest.mark.parametrize("merges, ignore", [([("a", "\u0100")], False), ([("\u0100", "\u0120")], False), ([("a", "b")], True)])
def test_tokens_that_reach_over_marks_or_depend_on_a_words_end(tmp_path, merges, ignore):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocab = {chr(c): i for i, c in enumerate(tokens.BYTES.values())} | {a + b: 256 + k for k, (a, b) in enumerate(merges)}
    tok = Tokenizer(models.BPE(vocab | {"cd": 300}, merges, ignore_merges=ignore))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.save(path := str(tmp_path / "t.json"))
    texts = ["a b ab cd aba a", "cd", " ba a\n a\x00 b ab", "", "a"]
    want = [np.array(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert tokens.Encoder(path).encode(texts) == want


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    from tokenizers import Tokenizer
    tok, rng = Tokenizer.from_file(tokens.default_tokenizer()), np.random.default_rng(7)
    texts = [" ".join("".join(rng.choice(list("abc"), rng.integers(1, 80))) for _ in range(60)) for _ in range(8)]
    want = [np.array(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    for placed in (np.zeros_like(tokens.PLACED), tokens.PLACED & np.uint64(3), tokens.PLACED):
        monkeypatch.setattr(tokens, "PLACED", placed)
        enc = tokens.Encoder(tokens.default_tokenizer(), keep=40)
        for _ in range(3):
            assert [enc.encode([t])[0] for t in texts] == want


def test_ids_are_counted_while_texts_are_encoded(spark, capsys):
    """The frequencies come from a row of each partition; the ids are not read for them."""
    docs = spark.createDataFrame([(i % 7 or None, f"word {i} and {'so on ' * (i % 5)}") for i in range(90)] + [(9, None)],
                                 "doc_id long, text string")
    rows = tokens.staged(tokens.tokenized(docs), "ids")
    got = rows.where("seen IS NULL").collect()
    ids = np.concatenate([np.frombuffer(r.ids, f"<u{r.width}") for r in got])
    assert len(got) == 91 and all(len(r.ids) == r.n * r.width for r in got)
    counted = tokens.counts(rows)
    assert {r.id: r.n for r in counted.collect()} == dict(zip(*(a.tolist() for a in np.unique(ids, return_counts=True))))
    counted.explain()
    assert "ReadSchema: struct<seen:binary>" in capsys.readouterr().out
