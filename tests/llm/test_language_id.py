import numpy as np
from conftest import DATA
from odd import TEXTS, none, odd

from tracelake.llm import language_id, registry


def test_query_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    out = registry.op10_language_id(spark, DATA).collect()
    held = [r for r in out if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in out)


def test_penalty_makes_weights_sparse():
    r = np.random.default_rng(0)
    rows = [(np.array([y, 2 + int(r.integers(0, 50))]), np.array([1.0, 0.1]), y) for y in r.integers(0, 2, 400).tolist()]
    dense, _ = language_id.learn_ftrl(rows, 52, 2, l1=0.0)
    sparse, _ = language_id.learn_ftrl(rows, 52, 2, l1=1.0)
    assert (sparse == 0).sum() > (dense == 0).sum() and sparse[0, 0] > 0 > sparse[1, 0]


def test_odd_rows(spark):
    docs = odd(spark)
    out = language_id.predict(docs, language_id.fit(docs)).collect()
    assert len(out) == len(TEXTS)
    und = {str(r.doc_id) for r in out if r.lang_pred == "und"}
    assert {"2", "3", "5"} <= und and not und & {"1", "4", "6", "7"}
    assert language_id.predict(none(spark), language_id.fit(docs)).count() == 0
    unknown = language_id.predict(docs, language_id.fit(none(spark))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def plain_grams(text):
    """N-grams of 1 to 3 characters, one after another."""
    letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    while "  " in letters:
        letters = letters.replace("  ", " ")
    return sorted(letters[k : k + n] for n in (1, 2, 3) for k in range(len(letters) - n + 1))


def coded(gram):
    code = 0
    for c in gram:
        code = code << 21 | (1 if c == " " else 1 + ord(c))
    return code


def test_pieces_give_the_grams_of_the_whole():
    for text in ["Größe, 東京!  ελ 123 naïve Ab", "a", "  ", "한국어 텍스트 " * 9, "x" * 40 + "  . " * 9 + "é"]:
        want = sorted(map(coded, plain_grams(text)))
        for piece in (1, 2, 3, 7, 1000):
            assert sorted(np.concatenate(list(language_id.grams(text, piece))).tolist()) == want, (text, piece)


def test_scores_equal_a_plain_loop(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language_id.fit(docs).open()
    for text in ["the house of the and", "der die das und ist", "東京 한국", "é è"]:
        have = [coded(g) for g in plain_grams(text)]
        z = model.bias.astype(float).copy()
        x = {k: (1 + np.log(have.count(c))) * model.idf[k] for k, c in enumerate(model.codes.tolist()) if c in have}
        norm = sum(v * v for v in x.values()) ** 0.5
        for k, v in x.items():
            z += v / norm * model.weights[k]
        e = np.exp((z - z.max()) / model.temperature)
        assert np.allclose(model.scores(*model.vector(text)), e / e.sum(), atol=1e-5)


def test_scripts_of_many_letters_and_ties(spark):
    r = np.random.default_rng(2)
    word = lambda lo, hi: "".join(chr(c) for c in r.integers(lo, hi, 3))
    kinds = {"zh": (0x4E00, 0x4E80), "ja": (0x5E00, 0x5E80), "ko": (0xAC00, 0xAC80), "am": (0x1200, 0x1240)}
    rows = [(k * 100 + i, " ".join(word(*kinds[lang]) for _ in range(40)), lang) for k, lang in enumerate(kinds) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language_id.predict(docs, language_id.fit(docs.where("doc_id % 2 = 0"))).collect()
    assert np.mean([x.lang_pred == rows[[q[0] for q in rows].index(x.doc_id)][2] for x in out]) > 0.95
    # nothing known of a text: equal scores go to the language that sorts first
    model = language_id.fit(docs)
    model.bias[:] = 0
    tie = spark.createDataFrame([(1, "ΩΨ")], "doc_id long, text string")
    assert [x.lang_pred for x in language_id.predict(tie, model).collect()] == ["am"]
