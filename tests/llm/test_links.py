"""Neighbour search, URL rules, quotations, pieces and the whole flow."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from corpusops.llm import jaccard_join, permutation_index, quotation_links, sentence_pieces, url_filters
from corpusops.llm.common import small_batches
from corpusops.llm.queries import PIECES, QUERIES, URL_RULES
from corpusops.session import stage

from .support import LONG, TEXTS, awkward, empty, prose, words
from .test_documents import plain_components, plain_counts

SMALL = "/root/testdata/sf0.001"


# neighbours -----------------------------------------------------------------------------------------


def exact(rows, k=10):
    ids, v = [i for i, _ in rows], np.array([x for _, x in rows], float)
    out = {}
    for i, q in enumerate(ids):
        if q % 100 == 0:
            d = np.sqrt(((v - v[i]) ** 2).sum(1))
            out[q] = sorted((float(d[j]), ids[j]) for j in range(len(ids)) if j != i)[:k]
    return out


def test_neighbours_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op3_permutation_index"](spark, folder).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(folder + "/embeddings.parquet").collect()]
    want = exact(rows)
    found = {q: [(r.score, r.vec_id) for r in sorted((x for x in got if x.query_id == q), key=lambda x: x["rank"])] for q in want}
    hit = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * 10 * len(want)
    for q in want:
        assert found[q] == sorted(found[q]) and len(found[q]) == 10


def test_neighbours_awkward_rows(spark):
    pick = random.Random(5)
    rows = [(i, [pick.random() for _ in range(3)]) for i in range(5)] + [(100, [1.0, 0.0, 0.0]), (101, [1.0, 0.0, 0.0]), (300, [1.0, 0.0, 0.0])]
    bad = [(200, None), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [float("nan"), 0.0, 1.0]), (9, [float("inf"), 0.0, 1.0]), (10, [1.0]), (None, [1.0, 2.0, 3.0]), (11, [])]
    frame = spark.createDataFrame(rows + bad + [rows[0]], "vec_id long, embedding array<float>").selectExpr("*", "'x' AS entry", "1 AS query_id")
    got = permutation_index.search(frame).collect()
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    want = exact(rows)
    for q in (0, 100, 300):
        mine = sorted((x for x in got if x.query_id == q), key=lambda x: x["rank"])
        assert [r.vec_id for r in mine] == [i for _, i in want[q]]
        assert [r.score for r in mine] == pytest.approx([d for d, _ in want[q]])
    assert {r.query_id for r in got} == {0, 100, 300} and permutation_index.search(frame.limit(0)).count() == 0


def test_many_copies_of_a_vector(spark):
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(1000 + i, [1.0 + i, 2.0]) for i in range(1, 30)]
    got = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by = {q: [r.vec_id for r in sorted((x for x in got if x.query_id == q), key=lambda x: x["rank"])] for q in (0, 100)}
    assert by == {0: list(range(1, 11)), 100: list(range(0, 10))}


# urls -----------------------------------------------------------------------------------------------


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:n], rest[n:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow")


URLS = [None, "", "no scheme/en/", "http://Example.NET/en/x?y#z", "https://a.b.example.net/en", "https://notexample.net/en/", "x://net", "x://net/", "x://net?/",
        "http://example.com/de/a/b/c", "ftp://a.org/fr/", "http://ORG/fr/1", "http://a..net/q", "://net/", "http://net/#a://b", "http://É.net/é", "http://x.example.com/de",
        "http://" + "a." * 3000 + "net/" + "d/" * 3000]


def test_urls_match_plain_rules(spark):
    more = [*URL_RULES, ("a.org", "/f", "block"), ("example.com", "", "allow"), ("b.example.net", "/en", "block")]
    for rules in (URL_RULES, more):
        frame = spark.createDataFrame(rules, "host string, path string, action string")
        pages = spark.createDataFrame([*enumerate(URLS), (3, URLS[3])], "page_id int, url string").selectExpr("*", "'x' AS host", "'y' AS rule")
        got = url_filters.judge(pages, frame).collect()
        assert len(got) == len(URLS) + 1
        assert {r.page_id: tuple(r)[1:] for r in got} == {i: plain_verdict(u, rules) for i, u in enumerate(URLS)}


def test_urls_without_rules_or_pages(spark):
    rules = spark.createDataFrame([(None, "/", "block"), ("", "/", "block")], "host string, path string, action string")
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    assert {r.verdict for r in url_filters.judge(pages, rules, default="block").collect()} == {"block"}
    assert url_filters.judge(pages.limit(0), rules).count() == 0


# quotations -----------------------------------------------------------------------------------------


def test_nested_quotations(spark):
    rows = [(1, 0, "a", "First point.\nSecond  POINT here."), (1, 1, "b", "> first point.\n> second point here.\n\nI agree."),
            (1, 2, "a", "On Monday b wrote:\n>> Second point here.\n> I agree.\nThanks"), (1, 3, "c", "> First point.\nother branch"),
            (1, 4, "d", "> never said\nnothing found"), (2, 0, "a", "I agree."), (None, 1, "x", "> I agree."), (3, None, "x", "t"), (1, 5, None, None), (1, 3, "c", "> First point.\nother branch")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS thread", "'x' AS lines")
    got = {(r.conv_id, r.turn): r for r in quotation_links.link(frame).collect()}
    assert len(got) == 9
    assert {k: r.reply_to for k, r in got.items()} == {(1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 4): None, (2, 0): None, (None, 1): None, (3, None): None, (1, 5): None}
    assert [got[1, t].thread for t in range(6)] == [0, 0, 0, 0, 4, 5] and [got[1, t].position for t in range(6)] == list(range(6))
    assert got[1, 1].text == "\nI agree." and got[1, 2].text == "Thanks" and got[1, 5].text == ""
    assert (got[1, 2].quote_levels, got[1, 2].quoted_lines, got[1, 2].linked_lines) == (2, 2, 2) and got[1, 4].linked_lines == 0
    assert quotation_links.link(frame.limit(0)).count() == 0


def test_wrapped_quotations(spark):
    """Passages are found however the original or the quotation is wrapped; cut sentences by their lines."""
    long = "The committee met on Tuesday to discuss the new budget. It found that costs had grown by a third! Why? Nobody knows"
    wrapped = "The committee met on\n> Tuesday to discuss the new budget. It found that\n> costs had grown by a third! Why?\n> Nobody knows"
    other = "A second paragraph runs over\nseveral lines of the letter. And it\nends here."
    rows = [(1, 0, "a", long + "\n\n" + other), (1, 1, "b", "> " + wrapped + "\n\nYes."),
            (1, 2, "c", "> A second paragraph runs over several\n> lines of the letter. And it ends here.\n\nNo."),
            (1, 3, "d", ">> " + wrapped.replace("\n> ", "\n>> ") + "\n> Yes.\nSo?"), (1, 4, "e", "> several lines of the letter. And it\nfragment"),
            (1, 5, "f", "> seven lines of nothing. Nor\n> this."), (1, 6, "g", "x \x0212\x03 y.\n> \x029\x03 Yes."), (1, 7, "h", "word. " * 20_000), (1, 8, "i", "> " + "word.\n> " * 9_000)]
    got = {r.turn: r for r in quotation_links.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[t].reply_to for t in range(9)] == [None, 0, 0, 1, 0, None, None, None, 7]
    assert [(got[t].quote_levels, got[t].quoted_lines, got[t].linked_lines) for t in (1, 2, 3, 5, 6, 8)] == [(1, 4, 4), (1, 2, 2), (2, 5, 5), (1, 2, 0), (1, 1, 0), (1, 9000, 9000)]


def test_latest_before_crosses_buckets(spark):
    known = spark.createDataFrame([("k", t) for t in (0, 10, 300, 5000)], "key string, turn long")
    asked = spark.createDataFrame([("k", t, t) for t in (0, 5, 10, 11, 299, 300, 301, 4999, 6000)] + [("z", 1, 1)], "key string, turn long, x long")
    got = {(r.key, r.turn): r.source for r in quotation_links.latest_before(asked, known, ["key"]).collect()}
    assert got == {("k", 0): None, ("k", 5): 0, ("k", 10): 0, ("k", 11): 10, ("k", 299): 10, ("k", 300): 10, ("k", 301): 300, ("k", 4999): 300, ("k", 6000): 5000, ("z", 1): None}


# pieces ---------------------------------------------------------------------------------------------

HARD = ["a", "  two  spaces   and\ttabs\n\nnl", "日本語のテキストです。漢字かな混じり文" * 9, "x" * 300, "abcabc" * 100, "🙂🙃 emoji ünï", "a▁b ▁▁ c", " " * 70 + "many", "▁",
        "supercalifragilisticexpialidocious" * 30, "".join(random.Random(2).choice("etaoinshr") for _ in range(3000)), "".join(random.Random(1).choice("abc ") for _ in range(900))]


def plain_pieces(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return [library.encode(t or "") for t in texts]


@pytest.mark.parametrize("chunk", [64, 200, 1 << 15])
def test_pieces_equal_the_library(spark, chunk):
    texts = HARD + [t if t is None else t[:4000] for t in TEXTS] + [prose(8, 300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sentence_pieces.decode(sentence_pieces.encode(frame, PIECES, chunk=chunk), PIECES).collect()
    want = plain_pieces(texts)
    assert len(got) == len(texts)
    for r in got:
        assert list(r.pieces) == want[r.key] and r.text == (texts[r.key] or "").replace("▁", " ")


def test_stretches_that_no_piece_joins_are_merged_once(monkeypatch):
    """Marks behind a word do not make it another word; texts of a sliced array keep their places."""
    lattice, merged = sentence_pieces.Lattice(sentence_pieces.read_model(PIECES)), []
    plain = sentence_pieces.Lattice._merged
    monkeypatch.setattr(sentence_pieces.Lattice, "_merged", lambda self, parts, scores: merged.append("".join(parts)) or plain(self, parts, scores))
    ends = ["", ",\n", ".\n", "\u4e00", "\U0001f642"]
    texts = ["skipped", *[f"nothingness{e}" for e in ends], "", *HARD, "", "nothingness"]
    array = pa.array(["\u2581" + t.replace(" ", "\u2581") if t else "" for t in texts]).slice(1)
    got = lattice.whole(array)
    assert got.to_pylist() == plain_pieces(texts[1:]) and merged.count("\u2581nothingness") == 1
    assert not [m for m in merged if m.startswith("\u2581nothingness") and m != "\u2581nothingness"]
    assert lattice.whole(array.slice(0, 0)).to_pylist() == [] and lattice.whole(pa.array(["", ""])).to_pylist() == [[], []]
    for word in ("\u2581nothingness,\n", "\u2581x" * 60, "a\u2581\u2581b.c"):
        assert lattice.word(word) == np.array(sum((lattice.numbers([p]) for p in lattice.merge(word)), []), np.int32).tobytes()


def unigram_model():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = sentence_pieces.UNIGRAM
    return proto


def best_sum(text, scores, longest, unknown):
    """Viterbi over all places of the text, in double precision."""
    best = [0.0] + [-float("inf")] * len(text)
    for i in range(1, len(text) + 1):
        best[i] = best[i - 1] + scores.get(text[i - 1], unknown)
        for a in range(max(0, i - longest), i - 1):
            if text[a:i] in scores:
                best[i] = max(best[i], best[a] + scores[text[a:i]])
    return best[-1]


def test_unigram_paths_have_the_best_sum():
    """The best of all paths, and never below the library's (whose ``encode`` misses some that its own n-best list has first)."""
    proto = unigram_model()
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    lattice = sentence_pieces.Lattice(sentence_pieces.parse_model(proto))
    score = {i: p.score for i, p in enumerate(proto.pieces)}
    margin = 2 * lattice.longest
    for text in HARD[1:2] + [prose(3, 60), "etaoinshr" * 60]:
        t = "▁" + text.replace(" ", "▁")
        parts = [(t[max(0, s - margin):s + 100 + margin], min(s, margin), min(100, len(t) - s)) for s in range(0, len(t), 100)]
        inner = sentence_pieces.boundary_states([lattice.matrix(p, a, a + n) for p, a, n in parts])
        got = [x for (p, a, n), i, j in zip(parts, [0, *inner], [*inner, 0]) for x in lattice.encode(p, a, a + n, i, j)]
        want = library.encode(text)
        assert library.decode(got) == library.decode(want)
        normal = all(x in lattice.scores for x in t)
        if normal:
            assert sum(score[x] for x in got) == best_sum(t, lattice.scores, lattice.longest, lattice.lowest)
        assert sum(score[x] for x in got) >= sum(score[x] for x in want)
    assert library.nbest_encode("the", nbest_size=3)[0] == lattice.encode("▁the", 0, 4)


def test_max_plus_product_is_associative():
    rng = np.random.default_rng(1)
    a, b, c = (rng.random(s) for s in ((1, 4), (4, 3), (3, 5)))
    assert np.allclose(sentence_pieces.combine(sentence_pieces.combine(a, b), c), sentence_pieces.combine(a, sentence_pieces.combine(b, c)))


def random_matrices(rng, n):
    sizes = [1, *rng.integers(1, 5, n - 1).tolist(), 1]
    return [(rng.random(x), rng.random(y)) if rng.random() < 0.4 else (rng.random((x, y)), None) for x, y in zip(sizes, sizes[1:])]


def test_products_of_ranges_equal_the_product_of_all():
    rng = np.random.default_rng(2)
    for _ in range(50):
        all_ = random_matrices(rng, int(rng.integers(2, 20)))
        full = [e if x is None else e[:, None] + x[None, :] for e, x in all_]
        want = full[0]
        for m in full[1:]:
            want = sentence_pieces.combine(want, m)
        cut = int(rng.integers(1, len(all_)))
        enter, leave = sentence_pieces.times(sentence_pieces.product(all_[:cut]), sentence_pieces.product(all_[cut:]))
        assert np.allclose(enter if leave is None else enter[:, None] + leave[None, :], want)


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_states_by_a_tree_of_products_equal_those_of_one_sweep(spark, monkeypatch, fan):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(sentence_pieces, "FAN", fan)
    texts = {k: random_matrices(rng, n) for k, n in ((1, 2), (2, 7), (3, 30))}
    rows = [(k, i, e.ravel().tolist(), None if x is None else x.tolist(), len(e)) for k, ms in texts.items() for i, (e, x) in enumerate(ms)]
    frame = spark.createDataFrame(rows, "id long, chunk int, enter array<double>, leave array<double>, rows int")
    got = {(r.id, r.chunk): (r.i, r.j) for r in sentence_pieces.scan_states(frame, 30).collect()}
    for k, ms in texts.items():
        inner = sentence_pieces.boundary_states(ms)
        assert [got[k, c] for c in range(len(ms))] == list(zip([0, *inner], [*inner, 0]))


def test_two_models_in_one_session(spark):
    """Workers keep the lattice of a model by its digest: each text is encoded with its own model."""
    unigram = sentence_pieces.parse_model(unigram_model())
    frame = spark.createDataFrame([(0, "of the other the")], "doc_id long, text string")
    lattices = [sentence_pieces.Lattice(m) for m in (sentence_pieces.read_model(PIECES), unigram)]
    t = "▁of▁the▁other▁the"
    want = [list(m.encode(t, 0, len(t))) for m in lattices]
    assert want[0] != want[1]
    for _ in range(3):
        assert list(sentence_pieces.encode(frame, PIECES).first().pieces) == want[0]
        assert list(sentence_pieces.encode(frame, "", model=unigram).first().pieces) == want[1]


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBER", 50)
    monkeypatch.setattr(sentence_pieces, "PAIRS", 50)
    lattice, library = sentence_pieces.Lattice(sentence_pieces.read_model(PIECES)), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in [prose(50 + i, 200) for i in range(5)]:
        t = "▁" + text.replace(" ", "▁")
        assert list(lattice.encode(t, 0, len(t))) == library.encode(text)
        assert len(lattice.words) <= 50 and len(lattice.older) <= 50 and len(lattice.pairs) <= 51


def test_pieces_awkward_rows(spark):
    docs = awkward(spark)
    keyed = docs.select(F.struct("doc_id", "source").alias("doc_key"), "text", "part", "size")
    got = sentence_pieces.encode(keyed, PIECES, key="doc_key")
    assert got.count() == docs.count() and sentence_pieces.encode(empty(spark), PIECES).count() == 0
    by = {r.key.doc_id: list(r.pieces) for r in got.collect()}
    assert by[0] == by[1] == [] and by[7] == plain_pieces([LONG])[0]


def test_long_texts_with_equal_keys_stay_apart(spark):
    long = [prose(20 + i, 60 + 15 * i) for i in range(4)]
    rows = [(None, long[0]), (None, long[1]), (7, long[2]), (7, long[3]), (7, long[3]), (7, "short")]
    got = sentence_pieces.encode(spark.createDataFrame(rows, "doc_id long, text string"), PIECES, chunk=64).collect()
    want = plain_pieces([t for _, t in rows])
    assert sorted((r.key or 0, list(r.pieces)) for r in got) == sorted((k or 0, p) for (k, _), p in zip(rows, want))
    keyed = spark.createDataFrame(rows, "doc_id long, text string").select(F.struct("doc_id").alias("key"), "text")
    got = sentence_pieces.encode(keyed, PIECES, key="key", chunk=64).collect()
    assert sorted(list(r.pieces) for r in got) == sorted(want)


# the flow -------------------------------------------------------------------------------------------


def test_stages_one_by_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    folder = "/root/testdata/sf0.01"
    held = {r.doc_id: r.text for r in docs.collect()}
    (_, rules), (_, votes), (_, near), (_, mixed), (_, pieces) = corpus_pipeline.STAGES
    kept = rules(spark, docs, folder)
    assert kept.columns == docs.columns
    base = {d for d, t in held.items() if (c := plain_counts(t))[0] >= 50 and 2 * c[4] <= c[0]}
    assert {r.doc_id for r in kept.collect()} <= base
    good = {r.doc_id for r in spark.read.parquet(folder + "/labels.parquet").where("quality = 1").collect()} & base
    assert len({r.doc_id for r in kept.collect()} & good) >= 0.98 * len(good)
    voted = votes(spark, docs, folder)
    assert voted.columns == docs.columns and good <= {r.doc_id for r in voted.collect()}
    single = near(spark, docs, folder)
    want = plain_components(list(held.items()), 5, 80)
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted({root for _, root in want.values()})
    mix = mixed(spark, docs, folder)
    assert mix.columns == docs.columns
    total = sum(len(words(t)) for t in held.values())
    assert sum(len(words(r.text)) for r in mix.collect()) == pytest.approx(total, rel=0.1)
    few = docs.where("doc_id < 60").unionByName(docs.where("doc_id < 5"))
    out = pieces(spark, few, folder).collect()
    expect = dict(zip(held, plain_pieces(held.values())))
    assert len(out) == few.count() and all(list(r.pieces) == expect[r.doc_id] for r in out)


def test_stages_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    for name in ("_id", "_first", "_digest", "_copy", "text_", "digest", "id", "first", "own", "copies", "component"):
        docs = docs.withColumn(name, F.lit("clash"))
    spark.createDataFrame([(4, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() <= 3 * docs.count(), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_near_duplicates_without_unique_ids(spark):
    base = prose(40, 210).split()
    a, n, b = (" ".join(base[i:i + 180]) for i in (0, 12, 24))  # a ~ n ~ b at 80 %, a and b do not link
    other = prose(41, 90)
    rows = [(1, a), (2, b), (None, n), (1, other), (None, prose(42, 90)), (None, prose(42, 90)), (None, ""), (3, other + " end")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.duplicates_stage(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, a), (1, other), (0, prose(42, 90)), (0, "")])


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """Whole texts, chunks, shingles and pairs of sets: an executor and its Python processes hold a batch of each."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}

    def watched(df, name):
        seen[name] = int(spark.conf.get(key))
        return stage(df, name)

    for module in (sentence_pieces, jaccard_join):
        monkeypatch.setattr(module, "stage", watched)
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"one two three four five six seven {i // 2} {'x' * 40 * (i % 2)}") for i in range(8)], "doc_id long, text string")
    chunk = 4 * max(len(p) for p, _, _ in sentence_pieces.read_model(PIECES)["pieces"])
    assert sentence_pieces.decode(sentence_pieces.encode(docs.unionByName(docs.selectExpr("doc_id + 8 AS doc_id", "repeat(text, 9) AS text")), PIECES, chunk=chunk), PIECES).count() == 16
    assert jaccard_join.linked_components(docs, 2, 50).count() == 8
    small = {name for name in seen if seen[name] <= 512}
    assert {"piece-matrices", "pieces", "shingle-sizes", "shingle-posts", "star-arrays", "star-links"} <= small
    assert spark.conf.get(key) == before
    with small_batches(spark, 3):
        sizes = spark.range(0, 10, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
        assert [r["n"] for r in sizes.collect()] == [3, 3, 3, 1]
