import random

import numpy as np

from tests.llm.samples import EDGES, text
from tidemart.llm.license_scan import ScanParams, Templates, align, fingerprints, scan, words_of
from tidemart.llm.license_templates import TEMPLATES


def words(t):
    raw = np.frombuffer(t.encode(), np.uint8)
    return words_of(raw, np.array([0, len(raw)]))[3].tolist()


def brute(t, params=ScanParams()):
    """Templates whose unbanded local alignment reaches the coverage."""
    out = set()
    own = words(t)
    for k, (_, _, template) in enumerate(TEMPLATES):
        theirs = words(template)
        matched, _, _ = align(own, theirs, -len(theirs), len(own))
        if matched >= params.min_coverage * len(theirs):
            out.add(k)
    return out


def mangled(seed):
    r = random.Random(seed)
    k = r.randrange(len(TEMPLATES))
    own = TEMPLATES[k][2].split()
    for _ in range(r.randrange(0, max(1, len(own) // 6) + 1)):
        at = r.randrange(len(own))
        own[at : at + r.randrange(2)] = ["changed"] * r.randrange(2)
    return text(seed, r.randrange(0, 60)) + ". " + r.choice([" ", "\n * "]).join(own).upper() + " " + text(seed + 1, r.randrange(0, 60))


def test_equals_full_alignment(docs):
    rows = [(i, mangled(i)) for i in range(80)] + [(100 + i, text(i, 80)) for i in range(20)]
    got = {}
    for r in scan(docs(*rows).repartition(3)).collect():
        got.setdefault(r.doc_id, set()).add(r.template)
    missed = 0
    for i, t in rows:
        expected = brute(t)
        assert got.get(i, set()) <= expected
        missed += len(expected - got.get(i, set()))
    # without an unbroken run of gram + window - 1 words nothing promises a fingerprint
    assert missed <= 2


def test_exact_notices_are_found_with_their_span(docs):
    for k, (name, kind, notice) in enumerate(TEMPLATES):
        t = "é " + text(k, 30) + "\n" + notice + "\n" + text(k + 50, 30)
        found = [r for r in scan(docs((k, t))).collect() if r.template == k]
        assert [(r.license, r.kind, r.coverage) for r in found] == [(name, kind, 1.0)]
        assert words(t[found[0].start : found[0].end]) == words(notice)


def test_each_occurrence_is_one_finding(docs):
    notice = TEMPLATES[0][2]
    t = " ".join([notice, text(1, 20), notice, notice, text(2, 200), notice])
    found = scan(docs((1, t))).collect()
    assert len(found) == 4 and all(r.matched == 5 for r in found)


def test_edge_cases(docs):
    assert scan(docs(*EDGES)).count() == 0
    assert scan(docs((1, "a")).where("false")).count() == 0
    assert scan(docs((1, TEMPLATES[0][2]), (1, TEMPLATES[0][2]), (None, TEMPLATES[0][2]))).count() == 3


def test_winnowing_keeps_one_of_each_window():
    raw = np.frombuffer((text(1, 50)).encode(), np.uint8)
    _, _, doc, hashes = words_of(raw, np.array([0, len(raw)]))
    for w in (1, 2, 5):
        _, at = fingerprints(hashes, doc, ScanParams(window=w))
        assert np.diff(np.concatenate([[-1], at, [len(hashes) - 2]])).max() <= w
    assert len(Templates(ScanParams()).words) == len(TEMPLATES)
