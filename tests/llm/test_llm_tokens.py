"""Token shards, SentencePiece coding and the pipeline."""

import tracemalloc
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from conftest_values import union_find
from freightflow.llm import common, pfair, piece_viterbi, token_shards, toxicity
from freightflow.llm.queries import QUERIES
from freightflow.session import work_folder
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(rows):
    """(doc_id, start, n, crc) of rows (doc_id, text), nulls first."""
    tokenizer, at, out = Tokenizer.from_file(WORDS), 0, []
    coded = [(d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for d, t in rows]
    for d, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, x[1].astype("<u2").tobytes())):
        out.append((d, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    return out


def test_shards_of_the_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op5_token_shards"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == plain_tokens(rows)


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    more = [(20, "don't <|endoftext|> x<|startoftext|>y"), (21, "ΑΣ Σ ß\x1cﬁ é '''ll"), (-5, "a b  \n")]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    found = token_shards.round_trip(docs, WORDS)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.collect()]
    assert sorted(got, key=lambda r: r[1]) == plain_tokens(docs.collect())
    assert token_shards.round_trip(no_docs, WORDS).count() == 0


def test_keyed_access(spark, odd_docs):
    path = token_shards.write(odd_docs, WORDS, work_folder(spark, "test-shards"))
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    shards = [token_shards.Shard(bytes(f.content)) for f in files]
    tokenizer = Tokenizer.from_file(WORDS)
    ids = tokenizer.encode("the same text", add_special_tokens=False).ids + [1]

    def find(*key):
        return [x.tolist() for s in shards if (x := s.get(*key)) is not None]

    assert find(1) == find(2) == find(2, 1) == [ids]
    assert find(2, 2) == find(77) == []
    assert find(4) == [[1]] and len(find(None)) == len(find(None, 1)) == 1


def test_perfect_hash():
    keys = token_shards.key_hashes(np.arange(5000) * 3, np.zeros(5000, bool), np.zeros(5000, int))
    table = token_shards.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(5000))
    assert token_shards.PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3
    table = token_shards.PerfectHash([], np.sort(keys))  # all keys listed
    assert sorted(table.slots(keys).tolist()) == list(range(5000))


def test_cores_of_words_are_encoded_once(monkeypatch):
    code, plain = token_shards.Encoder(WORDS), Tokenizer.from_file(WORDS)
    texts = ["Some words, SOME more: é. É", "", " ", "don't x<y (a) ...", "İ. ×. ÷, Aİ: ŉ! i̇.", "<|endoftext|> a", "\x85a. 1,"]

    def checked(texts):
        got = code.encode(pa.array(["cut off", *texts]).slice(1))
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, code.kind).tolist() for x in got.to_pylist()] == want

    checked(texts)
    sent, ids = [], code._ids
    monkeypatch.setattr(code, "_ids", lambda texts: sent.extend(texts) or ids(texts))
    checked(["some, words. MORE", "Words: More."])
    assert sent == []  # before, a core came again with each other case or stop behind it
    monkeypatch.setattr(token_shards, "CACHE_WORDS", len(code.known))
    checked(["new ones, ones some", "new"])
    assert "ones" not in code.known and not code.encode(pa.array([], pa.string()))


def brute_score(word, vocabulary):
    """The best sum of scores of any segmentation of a marked word."""
    best = [0.0] + [-np.inf] * len(word)
    for i in range(len(word)):
        inner = i > 0 and word[i] == piece_viterbi.MARK
        for j in range(i + 1, len(word) + 1):
            part = word[i:j]
            if part in vocabulary.pieces and piece_viterbi.MARK not in word[max(i, 1) : j]:
                best[j] = max(best[j], best[i] + vocabulary.pieces[part][1])
        if inner or word[i] not in vocabulary.pieces:
            best[i + 1] = max(best[i + 1], best[i] + vocabulary.byte_score * len(word[i].encode()))
    return best[-1]


def test_search_finds_the_best_segmentation(spark):
    code = piece_viterbi.Coder(PIECES)
    score = {i: s for i, s in code.vocabulary.pieces.values()}
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    words = sorted({w for t in texts for w in t.split(" ")} | {"a▁b", "日本", "\x00", "a" * 60, "x.\n"})
    for word in words:
        ids = np.frombuffer(code.encode([word])[0], "<u4").tolist() if word else []
        got = sum(score.get(i, code.vocabulary.byte_score) for i in ids)
        assert not word or abs(got - brute_score(piece_viterbi.MARK + word, code.vocabulary)) < 1e-9, word
    alone = piece_viterbi.search(sorted(piece_viterbi.MARK + w for w in words), code.vocabulary)
    shared = {w: piece_viterbi.search([w], code.vocabulary)[w] for w in alone}
    assert alone == shared


def test_library_decodes_the_ids(spark):
    code, model = piece_viterbi.Coder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in ("the cat sat.", "Größe und été", "a b c"):
        assert model.decode(np.frombuffer(code.encode([text])[0], "<u4").tolist()) == text


def test_pieces_come_back(spark, odd_docs, no_docs, monkeypatch):
    found = piece_viterbi.decode(piece_viterbi.encode(odd_docs, PIECES), PIECES)
    want = sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.decoded) for r in found.collect()) == want
    both = piece_viterbi.round_trip(odd_docs, PIECES)
    assert sorted((str(r.doc_id), r.decoded) for r in both.collect()) == want
    rows = piece_viterbi.training_rows(odd_docs, PIECES).collect()
    assert {r.doc_id: r.ids for r in rows}[4] == [] and all(len(r.ids) == r.n_pieces for r in rows)
    assert piece_viterbi.round_trip(no_docs, PIECES).count() == 0
    code = piece_viterbi.Coder(PIECES)
    monkeypatch.setattr(piece_viterbi, "CACHE_WORDS", 3)
    texts = ["one two three four five", "four five six", "one six"]
    assert [code.decode(x) for x in code.encode(texts)] == texts


def plain_shingles(text):
    """The set of runs of five words, or all words where there are fewer."""
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    kept = {r.doc_id for r in toxicity.scores(docs, labels).where("score < 0.3").collect()}
    largest = {}
    for d in sorted(kept):
        largest[text[d]] = d
    kept = sorted(largest.values())
    sets = [plain_shingles(text[d]) for d in kept]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if a == b or len(a & b) >= 0.8 * len(a | b)
    ]
    kept = {kept[r] for r in union_find(len(kept), links)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == kept and len(rows) == len(kept) < len(text)
    code = piece_viterbi.Coder(PIECES)
    assert all(code.decode(np.array(r.ids, "<u4").tobytes()) == text[r.doc_id] for r in rows)
    order = [(r.slot, r.place) for r in rows]
    assert order == sorted(set(order))


def test_stages_take_any_columns(spark):
    names = "slot int, place int, doc string, k long, t long, i int, ids string, _ff_slot int, _ff_id long"
    rows = [(i, f"text number {i}", "ab"[i % 2], 1, 2, "x", 3, 4, 5, "y", 6, 7) for i in range(40)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 40, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 40


def test_pipeline_of_an_empty_table(spark, no_docs):
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, no_docs, SF).count() == 0, name
    assert corpus_pipeline.STAGES[0][1](spark, no_docs, SF).count() == 0


def test_rows_of_the_last_stage_keep_the_mixture(spark):
    rows = [(i, f"some text {i}", "abc"[(i % 7) // 3]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = corpus_pipeline.to_pieces(spark, docs, None).collect()
    source, order = {d: s for d, _, s in rows}, [(r.slot, r.place) for r in got]
    assert sorted(r.doc_id for r in got) == list(range(1500)) and order == sorted(set(order))
    weight = {r.source: r.weight for r in pfair.mix(docs).collect()}
    taken, last = dict.fromkeys(weight, 0), {s: max(r.slot for r in got if source[r.doc_id] == s) for s in weight}
    for slot in range(min(last.values())):  # until the first source runs out
        for s in {source[r.doc_id] for r in got if r.slot == slot}:
            taken[s] += 1
        assert all(abs(taken[s] - (slot + 1) * w) < 1 for s, w in weight.items())


def test_the_mixture_is_numbered_after_one_exchange_and_without_python(spark):
    rows = [(i, f"some text {i}", "abc"[(i % 7) // 3]) for i in range(300)]
    docs = pfair.stored(spark.createDataFrame(rows, "doc_id long, text string, source string"), "test-rows")
    plan = pfair.placed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    window = plan[plan.index("Window [row_number()"):plan.index("REPARTITION_BY_NUM")]
    assert window.count("- Exchange") == 1


def test_coding_holds_few_times_its_batch():
    code = piece_viterbi.coder(PIECES)
    texts = [" ".join(f"{(i * 7919 + j) * 2654435761 % 2**40:x}" for j in range(2000)) for i in range(20)]
    tracemalloc.start()
    try:
        ids = code.encode(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [code.decode(x) for x in ids] == texts
    assert most < 40 * sum(map(len, texts))  # all words differ; 51 times before, 29 now


def test_workers_get_few_texts_at_once(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows, before = spark.range(0, 3000, 1, 1), spark.conf.get(key)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    with common.text_batches(spark):
        got = common.stored(common.map_arrow(rows, sizes, "n long"), "test-sizes").collect()
    assert sum(r.n for r in got) == 3000 and max(r.n for r in got) <= common.TEXT_ROWS
    assert spark.conf.get(key) == before
