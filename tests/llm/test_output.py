"""Tokens, packing, token files, sharding, chat, language ID, pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat, langid, packing, sharding, token_files, tokens
from ledgerline.llm.common import Scratch

from llm_support import SF, docs


def whole_ids(texts, end):
    tokenizer = tokens.Encoder.load(None).tokenizer
    return [np.array([*e.ids, end], dtype="<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_give_the_ids_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    parts = ["a", "ab.", "ß!", "Dž", "ª", "½", "B", "1", " ", " ", "\n", "\t", "'s", ".", "é", "漢", "\xa0", "​", "\U0001f600", "\x85", "　", "\x1c", "<|endoftext|>"]
    texts = ["", " ", "a  b", " lead", "trail ", "a \nb", "a\n b", "x" * 200] + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 50))) for _ in range(2_000)]
    encoder = tokens.Encoder.load(None)
    want = [w[:-1].tobytes() for w in whole_ids(texts, 0)]
    assert [encoder.encode(t) for t in texts] == want
    monkeypatch.setattr(tokens, "CACHE", 5)
    monkeypatch.setattr(tokens, "STRETCH", 7)
    assert [encoder.encode(t) for t in texts] == want


def fresh_ids(text, path=None):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(path or tokens.default_path()).encode(text, add_special_tokens=False).ids, dtype="<u4")


def test_added_tokens_in_a_text_get_their_ids(spark, monkeypatch, tmp_path):
    from tokenizers import AddedToken, Tokenizer

    rng = random.Random(7)
    parts = ["<|endoftext|>", "<|endoftext|", "|>", "ab", " ", "  ", "\n", ".", "é", "pad", "pad it", " pad"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> \n<|endoftext|>a"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 20))) for _ in range(100)]
    encoder = tokens.Encoder.load(None)
    plain = Tokenizer.from_file(tokens.default_path())
    flagged = Tokenizer.from_file(tokens.default_path())
    plain.add_tokens([AddedToken("pad", normalized=False), AddedToken("pad it", normalized=False)])
    flagged.add_tokens([AddedToken("pad", lstrip=True, single_word=True)])
    encoders = [(encoder, Tokenizer.from_file(tokens.default_path()))]
    for name, tokenizer in (("plain", plain), ("flagged", flagged)):
        tokenizer.save(f"{tmp_path}/{name}.json")
        encoders.append((tokens.Encoder(f"{tmp_path}/{name}.json"), Tokenizer.from_file(f"{tmp_path}/{name}.json")))
    for stretch in (tokens.STRETCH, 7):
        monkeypatch.setattr(tokens, "STRETCH", stretch)
        for own, alone in encoders:
            assert [own.encode(t) for t in texts] == [np.array(alone.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    # and in the operators' rows
    want = {end: [zlib.crc32(np.append(fresh_ids(t), end).astype("<u4").tobytes()) for t in texts[:3]] for end in (token_files.END, packing.END)}
    path = f"{Scratch(spark, 'files').root}/tokens"
    token_files.write_token_files(docs(spark, texts[:3]), path)
    assert [r.ids_crc32 for r in token_files.read_token_files(spark, path).orderBy("doc_id").collect()] == want[token_files.END]
    assert [r.ids_crc32 for r in packing.pack(spark, docs(spark, texts[:3])).orderBy("doc_id").collect()] == want[packing.END]


def check_pack(rows, texts, size):
    """``rows``: pieces as rows; ``texts``: one per document id."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    ids = dict(zip(texts, whole_ids(texts.values(), packing.END)))
    assert set(by_doc) == set(ids)
    for key, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, ids[key].size)
            assert p.ids_crc32 == zlib.crc32(ids[key][at : at + p.length].tobytes())
            at += p.length
        assert at == ids[key].size
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return 1 - sum(map(len, ids.values())) / (size * len(by_seq))


@pytest.mark.parametrize("size, keep, parts", [(2048, 32, 1), (256, 4, 5), (64, 2, 3)])
def test_packing_places_every_id_once_with_little_padding(spark, documents, size, keep, parts):
    texts = {r.doc_id: r.text for r in documents.collect()}
    df = documents.repartition(parts, "doc_id")
    rows = packing.pack(spark, df, size=size, open_windows=keep, min_cut=size // 32).collect()
    assert check_pack(rows, texts, size) < 0.05
    assert all(packing.ids_of(r.ids).size == r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_sequences_are_the_pieces_in_order(spark, documents):
    pieces = packing.pack(spark, documents)
    rows = defaultdict(list)
    for p in pieces.collect():
        rows[p.sequence_id].append((p.offset, p.ids))
    for s in packing.sequences(pieces).collect():
        assert s.ids == b"".join(x for _, x in sorted(rows[s.sequence_id])) and s.n_tokens * 4 == len(s.ids)


def test_packing_of_odd_and_empty_tables(spark, odd, empty):
    rows = packing.pack(spark, odd, with_ids=False).collect()
    ends = Counter(r.doc_id for r in rows if r.start + r.length == r.doc_tokens)
    assert ends == Counter(r.doc_id for r in odd.collect())
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert packing.pack(spark, empty).count() == 0


def test_token_files_round_trip(spark, documents):
    path = f"{Scratch(spark, 'files').root}/tokens"
    token_files.write_token_files(documents.repartition(7), path)
    texts = dict(sorted((r.doc_id, r.text) for r in documents.collect()))
    at, want = 0, {}
    for key, ids in zip(texts, whole_ids(texts.values(), token_files.END)):
        want[key] = (at, ids.size, zlib.crc32(ids.tobytes()))
        at += ids.size
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, path).collect()} == want


def test_blocks_of_any_ids_round_trip_and_seek():
    rng = np.random.default_rng(4)
    for size in (0, 1, 511, 512, 513, 4000):
        for top in (1, 2, 300, 50_257, 1 << 32):
            ids = rng.integers(0, top, size, dtype=np.uint64).astype("<u4")
            if size > 20:
                ids[:: 97] = (1 << 32) - 1  # exceptions
            cut = sorted({0, size, *rng.integers(0, size + 1, 3).tolist()})
            packed = [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]
            payload, count = token_files.encode_segment([7, None, -3, 9, 11][: len(packed)], packed)
            assert count == size
            back = list(token_files.decode_segment(payload))
            assert [k for k, _, _ in back] == [7, None, -3, 9, 11][: len(packed)]
            assert b"".join(x.astype("<u4").tobytes() for _, _, x in back) == ids.tobytes()
            assert (token_files.read_ids(payload, size // 3, size // 2) == ids[size // 3 : size // 2]).all()


def test_frames_are_smaller_than_raw_ids():
    ids = (np.arange(100_000) % 700).astype("<u4")
    ids[::1000] = 50_000
    payload, _ = token_files.encode_segment([1], [ids.tobytes()])
    assert len(payload) < 1.5 * ids.size


def test_token_files_encode_batches_together(monkeypatch):
    monkeypatch.setattr(token_files, "SPAN", 3000)
    sizes = [0, 500, 700, 600, 100, 5000, 10, 0, 2800, 300]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [k] * min(n, 1), "text": ["x" * n] * min(n, 1)}, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())])) for k, n in enumerate(sizes)]
    joined = list(token_files._joined(iter(batches)))
    assert [b.column("doc_id").to_pylist() for b in joined if b.num_rows] == [[1, 2, 3, 4], [5], [6, 8], [9]]
    assert [len(t) for b in joined for t in b.column("text").to_pylist()] == [n for n in sizes if n]
    assert list(token_files._joined(iter([]))) == []


def test_token_files_of_odd_and_empty_tables(spark, odd, empty):
    for df in (odd, empty):
        path = f"{Scratch(spark, 'files').root}/tokens"
        token_files.write_token_files(df, path)
        out = token_files.read_token_files(spark, path).orderBy("start").collect()
        assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in df.collect())
        assert [r.start for r in out] == [sum(x.n_tokens for x in out[:k]) for k in range(len(out))]
        assert [r.doc_id for r in out if r.doc_id is not None] == sorted(r.doc_id for r in df.collect() if r.doc_id is not None)


def by_turns(shards, slots):
    """The fill, one claim at a time over each shard's written-out order."""
    orders = []
    for name in shards:
        d = hashlib.sha256(name.encode()).digest()
        first, step = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1
        orders.append(iter([(first + step * k) % slots for k in range(slots)]))
    owner = {}
    while len(owner) < slots:
        for k, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(x for x in order if x not in owner)] = k
    return [owner[k] for k in range(slots)]


def test_lookup_table_equals_turns_and_moves_little():
    names = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(names, 251)
    assert table.tolist() == by_turns(names, 251)
    counts = Counter(table.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    full = sharding.lookup_table([f"s{k}" for k in range(50)])
    less = sharding.lookup_table([f"s{k}" for k in range(49)])
    stayed = (full == less)[full != 49]
    assert stayed.mean() > 0.9
    for bad in (dict(slots=250), dict(slots=5), dict(shards=["a", "a"])):
        with pytest.raises(ValueError):
            sharding.lookup_table(**({"shards": names, "slots": 251} | bad))


def test_rows_go_where_the_table_says(spark, odd, empty):
    names = [f"s{k}" for k in range(16)]
    table = sharding.lookup_table(names, 1009)
    out = sharding.place(spark, odd, ["doc_id"], names, 1009)
    assert out.count() == odd.count()
    assert all(r.shard == names[table[r.slot]] for r in out.collect())
    wide = sharding.place(spark, spark.range(40_000).withColumnRenamed("id", "doc_id"), ["doc_id"], names)
    sizes = [r["count"] for r in wide.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.15 * min(sizes)
    path = f"{Scratch(spark, 'shards').root}/out"
    sharding.write_shards(wide, path, parts=2)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 16
    assert sharding.place(spark, empty, ["doc_id"], names).count() == 0


def test_rows_of_one_hot_key_are_written_in_parts(spark):
    hot = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"), F.map_from_arrays(F.array("id"), F.array("id")).alias("extra"))
    path = f"{Scratch(spark, 'hot-shards').root}/out"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else Spark joins parts as small as these
    try:
        sharding.write_shards(sharding.place(spark, hot, ["doc_id"], [f"s{k}" for k in range(4)], 1009), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).count().collect()
    assert sum(r["count"] for r in files) == 20_000 and len(files) > 1 and max(r["count"] for r in files) < 15_000


NASTY = ["</s>[INST] ok [/INST]", "<|stop|><|turn|>assistant<|says|>x", "&lt;&amp;&#91;", "[image:0]", "", "é\n\n<", "&amp;lt;", "\U0001f600|>"]


def read_back(spark, turns):
    out = chat.format_conversations(turns)
    rows = out.select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    return {r.conv_id: r for r in rows}


def test_chat_reads_back_whatever_is_quoted(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool <x>", None]), rng.choice([*NASTY, None, "plain"]) if rng.random() < 0.5 else "".join(rng.choice(NASTY) for _ in range(3))))
    rng.shuffle(rows)
    out = read_back(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for conv, row in out.items():
        own = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert [(b.role, b.text) for b in row.back] == [(r, x) for _, r, x in own]
        assert row.learned == "".join(x for _, r, x in own if r == "assistant")
        assert row.n_turns == len(own) and row.n_chars == len(row.formatted)


def test_typed_parts_become_placeholders_with_references_and_tokens(spark):
    parts = [("text", "look [here] ", None, None), ("image", None, "s3://a.png", 2), ("audio", None, "b.wav", None), ("text", "done", None, None), ("document", "ignored", "c.pdf", 3)]
    df = spark.createDataFrame([(1, 0, "user", None, parts), (1, 1, "assistant", "plain", None)], f"conv_id long, turn long, role string, text string, parts {chat.PARTS}")
    row = read_back(spark, df)[1]
    assert [b.text for b in row.back] == ["look [here] [image:1][audio:2]done[document:4]", "plain"]
    assert "look &#91;here] [image:1][audio:2]done[document:4]" in row.formatted
    assert [(a.turn, a.part, a.type, a.ref) for a in row.attachments] == [(0, 1, "image", "s3://a.png"), (0, 2, "audio", "b.wav"), (0, 4, "document", "c.pdf")]
    assert row.n_tokens == 3 + 2 * 256 + 25 + 1 + 3 * 640 + 2


def test_chat_of_odd_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string, head string, turns int, formatted string"
    rows = [(None, None, None, None, "h", 1, "f"), (None, None, None, None, "h", 1, "f"), (2, 1, "user", "b", "h", 1, "f"), (2, 1, "user", "a", "h", 1, "f")]
    out = read_back(spark, spark.createDataFrame(rows, schema))
    assert [(b.role, b.text) for b in out[None].back] == [("", ""), ("", "")]
    assert [b.text for b in out[2].back] == ["a", "b"]
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_language_model_is_accurate_on_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(table)
    out = langid.predict(table, model).join(table.select("doc_id", "lang", langid.held_out().alias("held")), "doc_id").where("held")
    assert out.count() > 200 and out.where("lang_pred = lang").count() >= 0.98 * out.count()
    assert out.where("score < 0 or score > 1").count() == 0
    # the prediction is the text's alone
    blind = langid.predict(table.select((F.col("doc_id") * 0).alias("doc_id"), "text"), model)
    assert sorted(r.lang_pred for r in blind.collect()) == sorted(r.lang_pred for r in langid.predict(table, model).collect())


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(5)
    model = langid.Model(["a", "b", "c"])
    codes = rng.integers(0, 256, (6, 4)).astype(np.intp)
    codes[4:, 1] = langid.PAD
    lang = np.array([0, 1, 2, 0])

    def loss():
        states = np.concatenate([model.ahead.forward(codes, []), model.back.forward(codes[::-1], [])[::-1]], axis=2).astype(np.float64)
        scores = states @ model.out + model.bias
        scores -= np.log(np.exp(scores).sum(axis=-1, keepdims=True))
        real = codes != langid.PAD
        return -scores[:, np.arange(4), lang][real].sum() / real.sum()

    for weights, grad in zip(model.params(), model.step(codes, lang)):
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in weights.shape)
            if weights.shape[0] == langid.PAD + 1:
                at = (int(codes[rng.integers(0, 4), 0]), at[1])
            kept = weights[at]
            weights[at] = kept + 1e-2
            up = loss()
            weights[at] = kept - 1e-2
            down = loss()
            weights[at] = kept
            assert abs((up - down) / 2e-2 - grad[at]) < 2e-3


def test_fast_states_equal_the_training_pass():
    model = langid.Model(["a", "b"])
    codes = np.random.default_rng(1).integers(0, 257, (20, 9)).astype(np.intp)
    assert np.allclose(model.ahead.states(codes), model.ahead.forward(codes, []), atol=1e-5)


def test_language_of_odd_and_empty_tables(spark, odd, empty):
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd).collect()}
    assert out[1] == out[2] == out[3] == out[7] == ("und", 0.0)
    assert out[4][0] == "en" and out[5][0] == "en"
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.identify(docs(spark, ["some words"]).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_pipeline_stages_keep_what_they_should(spark):
    import corpus_pipeline as P

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    last = rows.agg(F.max("doc_id")).first()[0]
    more = docs(spark, [None, "1234 5678", f"Some words first. {bench} And after.", "the key is token = 'abcd1234efgh5678' so hide it well"], first=last + 1)
    df = rows.select(*P.COLUMNS).unionByName(more.select(*P.COLUMNS))
    df = df.unionByName(df.where(F.col("doc_id") == 3))
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]
    for name, stage in P.STAGES[:-1]:
        before, df = df, stage(spark, df, SF).cache()
        assert df.columns == P.COLUMNS and df.count() <= before.count()
        ids = {r.doc_id for r in df.select("doc_id").collect()}
        if name == "language_id":
            assert not ids & {last + 1, last + 2} and len(ids) >= before.select("doc_id").distinct().count() - 2 - 2
        if name == "near_dedup":
            assert df.where("doc_id = 3").count() <= 1 and df.count() == len(ids)
        if name == "decontamination":
            assert last + 3 not in ids
        if name == "secret_scan":
            assert df.where(F.col("doc_id") == last + 4).first().text == "the key is [SECRET]' so hide it well"
    packed = P.STAGES[-1][1](spark, df, SF).collect()
    check_pack(packed, {r.doc_id: r.text for r in df.collect()}, 2048)


def test_pipeline_rejects_texts_of_no_language_in_particular(spark):
    import corpus_pipeline as P

    rows = spark.read.parquet(f"{SF}/documents.parquet").select(*P.COLUMNS)
    plain = rows.where("length(text) > 200")
    by_lang = {r.lang: r.words for r in plain.where("lang is not null").groupBy("lang").agg(F.split(F.concat_ws(" ", F.sort_array(F.collect_list("text"))), r"\s+").alias("words")).collect()}
    mixed = []
    for size in (1, 2, 5, 20, 60, 100):
        for at in range(0, 200, 40):
            mixed.append(" ".join(" ".join(words[at : at + size]) for words in by_lang.values()))
    last = rows.agg(F.max("doc_id")).first()[0]
    df = rows.unionByName(docs(spark, mixed, last + 1).withColumn("lang", F.lit(None).cast("string")).select(*P.COLUMNS))
    kept = {r.doc_id for r in P.keep_languages(spark, df, SF).collect()}
    scores = {r.doc_id: r.score for r in langid.identify(df).collect()}
    lettered = {r.doc_id for r in df.where(F.col("text").rlike("[A-Za-z]")).collect()}
    assert kept == {i for i in lettered if scores[i] >= P.ABOVE_UNIFORM / len(by_lang)}
    assert len(lettered - kept) > 0 and {r.doc_id for r in plain.collect()} <= kept
    one = P.keep_languages(spark, rows.withColumn("lang", F.lit("en")), SF)
    assert one.count() == rows.where(F.col("text").rlike(r"\p{L}")).count()


def test_pipeline_names_the_language_of_every_document(spark, odd, monkeypatch):
    import corpus_pipeline as P

    seen, predict = [], langid.predict
    monkeypatch.setattr(langid, "predict", lambda *a, **k: seen.append(predict(*a, **k)) or seen[-1])
    more = docs(spark, ["ein paar deutsche Worte und noch mehr davon"] * 8 + [None, "1234"], first=20).withColumn("lang", F.lit("de"))
    df = odd.select(*P.COLUMNS).unionByName(more.select(*P.COLUMNS)).repartition(3)
    kept = P.keep_languages(spark, df, SF)
    assert len(seen) == 1 and sorted(map(repr, seen[0].select(*P.COLUMNS).collect())) == sorted(map(repr, df.collect()))
    apart = predict(df, langid.train(df)).withColumn("score", F.round("score", 6))
    assert sorted(map(repr, seen[0].withColumn("score", F.round("score", 6)).select(*apart.columns).collect())) == sorted(map(repr, apart.collect()))
    named = seen[0].where(f"lang_pred <> 'und' and score >= {P.ABOVE_UNIFORM / 2}").select(*P.COLUMNS)
    assert {r.lang_pred for r in seen[0].collect()} == {"en", "de", "und"}
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, named.collect()))


def test_pipeline_keeps_the_smallest_of_rows_that_repeat_an_id(spark):
    import corpus_pipeline as P

    rows = [(1, "b text of its own with words enough", "en", "a", 1), (1, "a text that shares nothing else at all", "en", "a", 2), (1, "a text that shares nothing else at all", None, "a", 2), (2, "another one that is not repeated", "en", "a", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for order in ("n_chars", "-n_chars"):
        kept = P.drop_near_duplicates(spark, df.orderBy(F.expr(order)), SF).orderBy("doc_id").collect()
        assert [tuple(r) for r in kept] == [rows[2], rows[3]]


def test_pipeline_of_odd_and_empty_tables(spark, odd, empty):
    import corpus_pipeline as P

    for df in (odd, empty):
        for _, stage in P.STAGES:
            df = stage(spark, df, SF)
        df.collect()


def test_ties_of_a_turn_are_in_the_order_of_their_texts(spark):
    rows = [(1, 0, "user", t) for t in ("<b", "0", "[c", "&", "A")] + [(1, 0, "<role", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = chat.format_conversations(turns).select(chat.read_turns(F.col("formatted")).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in read] == sorted((r[2], r[3]) for r in rows)
