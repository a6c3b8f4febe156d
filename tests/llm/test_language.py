import random

import numpy as np
import pytest

from strataframe.llm import language as L
from strataframe.llm.texts import sentences

PARTS = {
    "en": (["The supplier", "Every engineer", "The rear cover"], ["has measured the gap", "shall withstand the load", "must be checked twice"], ["before the next build.", "on different days.", "without visible damage."]),
    "de": (["Der Lieferant", "Die Abdeckung", "Das Gehäuse"], ["wird vor der Auslieferung geprüft", "darf sich nicht verschieben", "muss gereinigt werden"], ["und danach verpackt.", "weil es sonst klemmt.", "bevor der Versuch endet."]),
    "fr": (["Le fournisseur", "La batterie", "Le capot"], ["ne doit pas bouger", "est vérifié avec soin", "doit être nettoyé"], ["avant la mesure.", "dans cet atelier.", "sans dommage visible."]),
    "es": (["El proveedor", "La batería", "La tapa"], ["no debe moverse más", "se comprueba con cuidado", "debe limpiarse bien"], ["antes de la prueba.", "en esta sección.", "sin daños visibles."]),
}


def texts(lang, n, seed):
    r = random.Random(seed)
    return [" ".join(r.choice(p) for p in PARTS[lang]) for _ in range(n)]


def test_held_out_accuracy_with_wrong_labels():
    langs = list(PARTS)
    x, y = [], []
    for i, k in enumerate(langs):
        for j, t in enumerate(texts(k, 120, i)):
            x.append(t)
            y.append(L.LANGUAGES.index(k if j % 8 else langs[(i + 1) % 4]))
    model = L.fit(x, y, len(L.LANGUAGES))
    model = L.fit(x, L.scores(model, x).argmax(1).tolist(), len(L.LANGUAGES))
    right = [L.LANGUAGES[p] == k for k in langs for p in L.scores(model, texts(k, 50, 77)).argmax(1)]
    assert np.mean(right) > 0.98


def test_scores_of_odd_texts():
    model = L.fit(["abc def"], [0], 8)
    p = L.scores(model, ["", "123 !?", "abc"])
    assert p.shape == (3, 8) and np.allclose(p.sum(1), 1) and np.allclose(p[0], 1 / 8)
    assert L.scores(model, []).shape == (0, 8)
    many = ["abc"] * (L.CHUNK + 3)
    assert L.scores(model, many).shape == (L.CHUNK + 3, 8)


def test_confidence_is_earned():
    """On held-out sentences, the sure ones are right as often as they say."""
    langs = list(PARTS)
    x = [t for i, k in enumerate(langs) for t in texts(k, 200, i)]
    y = [L.LANGUAGES.index(k) for k in langs for _ in range(200)]
    model = L.fit(x, y, len(L.LANGUAGES))
    held = [(k, t) for k in langs for t in texts(k, 100, 501)]
    short = [(k, " ".join(t.split()[:3])) for k, t in held]  # hard ones, too
    p = L.scores(model, [t for _, t in held + short])
    sure = p.max(1) >= L.CONFIDENT
    right = np.array([L.LANGUAGES[i] == k for i, (k, _) in zip(p.argmax(1), held + short)])
    assert right[sure].mean() >= L.CONFIDENT and sure.mean() > 0.5


def test_other_languages_are_unknown(spark):
    rows = [(f"d{k}", f"a{j}", " ".join(texts(k, 8, 100 * i + j))) for i, k in enumerate(PARTS) for j in range(30)]
    strange = " ".join("Přístroj zůstává vypnutý, dokud teplota skříně neklesne pod nejnižší hodnotu uvedenou výrobcem čerpadla." for _ in range(3))
    b = spark.createDataFrame([*rows, ("x", "cs", strange)], "doc_id string, anchor string, body string")
    lab = spark.createDataFrame([(d, a, d[1:]) for d, a, _ in rows] + [("x", "cs", "en")], "doc_id string, anchor string, label string")
    found = L.segments(b, L.train(lab.filter("doc_id != 'x'"), b))
    got = {(r.doc_id, r.anchor): r.language for r in found.collect()}
    assert got["x", "cs"] == "und" and all(got[d, a] == d[1:] for d, a, _ in rows)
    assert L.mislabelled(found, lab).count() == 0


@pytest.mark.parametrize(("text", "lang"), [("en-US", "en"), ("ZH", "zh"), ("zh-cn", "zh"), ("pt_PT", "pt"), ("German", "de"), ("dutch", "nl"), ("und", None), ("", None), (None, None), ("unknown", None), ("xx", None)])
def test_labels(text, lang):
    assert L.label(text) == lang


def test_sentences():
    def of(t):
        return [t[a:b].strip() for a, b in sentences(t)]

    assert of("The gap is 3.5 mm wide. It was measured twice on Monday.") == ["The gap is 3.5 mm wide.", "It was measured twice on Monday."]
    assert of("check thermal pad\n- spare cover\n1. one") == []
    assert of("合上盖子之后，键盘框架进入休眠状态。没有人能够解释为什么。") == ["合上盖子之后，键盘框架进入休眠状态。", "没有人能够解释为什么。"]
    assert of("The load returned to 3.9 W. Nobody could explain why it did.") == ["The load returned to 3.9 W.", "Nobody could explain why it did."]
    assert of("") == []


def test_found(spark):
    rows, labels = [], []
    for i, k in enumerate(PARTS):
        for j in range(12):
            rows.append((f"d{k}", f"a{j}", " ".join(texts(k, 6, 100 * i + j))))
            labels.append((f"d{k}", f"a{j}", {0: None, 1: "", 2: "ja"}.get(j, k.upper())))
    rows += [("x", "mix", " ".join(texts("en", 4, 1) + texts("de", 4, 2))), ("x", "null", None), ("x", "blank", " "), ("x", "figures", "1\t2\n3\t4"), ("x", "two", " ".join(texts("fr", 3, 3)))]
    labels += [("x", "mix", "en"), ("x", "null", "en"), ("x", "two", "fr-FR")]
    b = spark.createDataFrame([(*r, "c") for r in rows], "doc_id string, anchor string, body string, language string")
    lab = spark.createDataFrame(labels, "doc_id string, anchor string, label string")
    found = L.segments(b, L.train(lab, b))
    got = {tuple(r) for r in L.mislabelled(found, lab).collect()}
    want = {(f"d{k}", f"a{j}", k) for k in PARTS for j in range(3)} | {("x", "mix", "en"), ("x", "mix", "de")}
    assert got == want
    mix = sorted((r.start, r.language) for r in found.filter("anchor = 'mix'").collect())
    assert [k for _, k in mix] == ["en", "de"]
    assert {(r.doc_id, r.anchor): r.language for r in L.documents(found).collect()}[("dfr", "a5")] == "fr"
    assert L.segments(b.limit(0), L.train(lab.limit(0), b)).count() == 0
