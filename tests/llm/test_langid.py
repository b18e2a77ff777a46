import zlib

import numpy as np
from helpers import LONG, MID, docs_of, odd_documents

from salescope.llm import codes, langid
from salescope.llm.queries import op1_language_id
from salescope.sources.tables import table


def test_contract_and_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, MID, "documents").collect()}
    out = op1_language_id(spark, MID).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    right = n = 0
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.held_out:
            n += 1
            right += r.lang_pred == docs[r.doc_id].lang
    assert right / n > 0.98
    assert sum(r.accepted for r in out) / len(out) > 0.97


def test_model_is_a_distribution(spark):
    table_ = codes.char_table(False)
    texts = ["abab abba baba " * 3, "caca acca " * 4]
    grams, lang = [], []
    for i, t in enumerate(texts):
        c, _, _ = codes.normalise([t], table_)
        line = np.concatenate([[32, 32], c])
        for j in range(2, len(line)):
            grams.append(line[j - 2:j + 1])
            lang.append(i)
    joint, n = np.unique(np.column_stack([lang, np.array(grams)]), axis=0, return_counts=True)
    model = langid.kneser_ney(["x", "y"], joint[:, 1:].astype(np.uint32), joint[:, 0], n, table_)
    alphabet = [ord(c) for c in "abc "]
    for context in ("ab", "ca", " a", "bb", "cc"):
        total = np.zeros(2)
        for c in alphabet:
            line = np.array([ord(context[0]), ord(context[1]), c], np.uint32)
            total += np.exp(model.gram_logs(codes.gram_hashes(line, 3), np.array([2]))[0])
        unseen = np.array([ord(context[0]), ord(context[1]), ord("z")], np.uint32)
        total += np.exp(model.gram_logs(codes.gram_hashes(unseen, 3), np.array([2]))[0])
        assert np.allclose(total, 1, atol=1e-3), context


def test_long_text_in_pieces_scores_like_a_whole(spark, monkeypatch):
    docs = docs_of(spark, [(i, f"some plain words of text number {i} here and there " * 3, "en", "a")
                           for i in range(60)])
    model = langid.fit_languages(docs)
    text = "plain  words here,   and there of some text " * 50
    whole = model.cross_entropies([text, "other"])
    monkeypatch.setattr(langid.pieces, "__defaults__", (37,))
    parts = model.cross_entropies([text, "other"])
    for a, b in zip(whole, parts):
        assert np.allclose(a, b, rtol=1e-5)


def test_odd_rows_and_junk(spark):
    train = docs_of(spark, [(i, f"the words of an english text {i} are like this one and that one " * 4, "en", "a")
                            for i in range(80)] + [
        (100 + i, f"les mots du texte francais {i} sont comme celui ci et celui la " * 4, "fr", "b")
        for i in range(80)])
    model = langid.fit_languages(train)
    rows = odd_documents(LONG) + [(8, "xqzj kvwx qqzx jjvk wxqz " * 20, "en", "a")]
    out = {(r.doc_id, r.text): r.language for r in
           langid.identify(docs_of(spark, rows, clashes=True), model).collect()}
    assert len(out) == len(set((r[0], r[1]) for r in rows))
    for key in ((2, None), (3, ""), (4, " \t\n\n "), (7, "12345 !!! ???")):
        assert out[key].lang_pred == "und" and out[key].score == 0 and not out[key].accepted
    assert out[(8, rows[-1][1])].accepted is False
    assert out[(None, "le renard brun saute par dessus le chien")].lang_pred == "fr"
    none = langid.fit_languages(docs_of(spark, [(1, "text", None, "a")]))
    assert langid.identify(docs_of(spark, [(1, "text", None, "a")]), none).first().language.lang_pred == "und"
    assert langid.identify(docs_of(spark, []), model).count() == 0
