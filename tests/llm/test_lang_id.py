import random

from tests.llm.samples import EDGES
from tidemart.llm.lang_id import LangParams, fit, identify, keep_identified

TOKENS = {"aa": ["zuber", "keit", "lich", "schaft", "und", "der"], "bb": ["ation", "eux", "que", "les", "ment", "aille"]}


def sample(n=120):
    rows = []
    for i in range(n):
        r, lang = random.Random(i), "aa" if i % 2 else "bb"
        rows.append((i, " ".join("".join(r.choices(TOKENS[lang], k=r.randrange(1, 4))) for _ in range(60)), lang))
    return rows


def test_finds_held_out_languages(docs):
    df = docs(*sample())
    got = {r.doc_id: r for r in identify(df, fit(df)).collect()}
    assert all(got[i].lang_pred == lang and not got[i].rejected and 0.5 < got[i].score <= 1 for i, _, lang in sample())


def test_labels_of_the_held_out_fold_teach_nothing(docs):
    from zlib import crc32

    rows = sample()
    swapped = [(i, t, "zz" if crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert {n for n, _ in fit(docs(*swapped))} == {"aa", "bb"}
    kept = [(i, t, None if crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert fit(docs(*rows)) == fit(docs(*kept))


def test_shared_headers_do_not_hide_the_bodies(docs):
    header = "this page is licensed for reading by everyone who holds a ticket " * 7
    rows = [(i, header + t, lang) for i, t, lang in sample()]
    got = {r.doc_id: r for r in identify(docs(*sample()), fit(docs(*rows))).collect()}
    assert all(got[i].lang_pred == lang and not got[i].rejected for i, _, lang in sample())


def test_every_language_is_known(docs):
    rows = [(i, f"word{i} other", f"l{i % 130}") for i in range(1300)]
    assert {n for n, _ in fit(docs(*rows))} == {f"l{k}" for k in range(130)}


def test_edge_cases(docs):
    df = docs(*[(i, t, "aa") for i, t in EDGES], (950, "12 34 !!", "aa"), *sample())
    got = {r.doc_id: r for r in identify(df, fit(df)).collect()}
    for i in (900, 901, 902, 950):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert identify(df, fit(df)).count() == len(EDGES) + 121
    nothing = df.where("false")
    assert identify(nothing, fit(nothing)).count() == 0
    assert {r.lang_pred for r in identify(df, []).collect()} == {"und"}


def test_narrow_margins_are_rejected(docs):
    df = docs(*sample(), (500, "xyzw vvv qqq"), (501, None), (502, ""))
    kept = keep_identified(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(120))
    strict = {r.doc_id for r in keep_identified(df, LangParams(narrow=2.0)).collect()}
    assert not strict
