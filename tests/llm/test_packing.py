import random
import zlib

import numpy as np

from tests.llm.samples import EDGES, text
from tidemart.llm.packing import Encoder, PackParams, fullest, pack, plan, segments
from tidemart.llm.queries import word_tokenizer


def ids_of(t):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(word_tokenizer()).encode(t or "", add_special_tokens=False).ids, 0]


def check(rows, got, capacity):
    """Every piece of every document once, with right content, and sequences without gap or overlap."""
    expected = []
    for doc, t in rows:
        ids = ids_of(t)
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            expected.append((doc, n, at, len(part) // 4, zlib.crc32(part)))
    assert sorted(expected, key=repr) == sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr)
    placed = {}
    for r in got:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in placed.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(placed), sum(r.length for r in got)


def test_packs_every_document(docs):
    rows = [(i, text(i, random.Random(i).randrange(1, 120))) for i in range(150)] + [(500, text(3, 900)), (501, text(4, 31)), (501, text(4, 31))] + EDGES
    rows = [r for r in rows if r[0] != 906]
    got = pack(docs(*rows).repartition(6), PackParams(word_tokenizer(), capacity=256)).collect()
    sequences, tokens = check(rows, got, 256)
    assert sequences <= -(-tokens // 256) + 1


def test_empty_table(docs):
    assert pack(docs((1, "a")).where("false"), PackParams(word_tokenizer())).count() == 0


def test_ids_are_returned_on_request(docs):
    row = pack(docs((1, "the quiet house")), PackParams(word_tokenizer()), with_ids=True).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == ids_of("the quiet house")


def test_encoder_equals_the_tokenizer():
    r = random.Random(5)
    parts = ["It's", "we'LL.", "don't,", "x'.", "Ärger", "ÉTÉ", "e\u0301", "\u0301a", "a.,", "..", ".", "İstanbul", "ΟΔΟΣ.", "n0.5,", "東京.",
             "<|endoftext|>", "\u00a0", "\u2003b", "\x1c", "\x85c", "'s", "''s", "a\u200bb", "1.", "😀,", "ß.", "ﬁ."]
    encoder = Encoder(word_tokenizer(), 50)
    for _ in range(400):
        t = "".join(r.choice(parts) + r.choice([" ", "\n", "\t", "\r", "  ", "", " "]) for _ in range(r.randrange(0, 9)))
        assert np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() == ids_of(t)[:-1], t
    for doc, t in EDGES[:8]:
        assert np.frombuffer(encoder.encode((t or "").encode()), "<u4").tolist() == ids_of(t)[:-1]


def test_fullest_equals_trying_all():
    r = random.Random(6)
    for _ in range(200):
        counts = {r.randrange(1, 15): r.randrange(0, 4) for _ in range(5)}
        room = r.randrange(0, 40)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
        taken = fullest(counts, room)
        assert sum(n * k for n, k in taken.items()) == max(sums)
        assert all(k <= counts[n] for n, k in taken.items())


def test_plan_uses_every_piece_once():
    r = random.Random(7)
    counts = {n: r.randrange(0, 2000) for n in range(1, 257)}
    made = plan(counts, 256)
    used = {n: 0 for n in counts}
    for lengths, times in made:
        assert times > 0 and sum(n * k for n, k in lengths.items()) <= 256
        for n, k in lengths.items():
            used[n] += k * times
    assert used == counts
    total = sum(n * c for n, c in counts.items())
    assert sum(times for _, times in made) <= 1.02 * total / 256 + 1
    assert all((np.diff(rows[:, 0]) > 0).all() for rows in segments(made).values())
    assert len(made) < 4000


def test_words_are_split_only_for_tokenizers_that_drop_white_space(tmp_path):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    from tidemart.llm.packing import splits_at_spaces

    read = lambda name: json.load(open(public_tokenizers.path(name), encoding="utf-8"))
    assert splits_at_spaces(read("word_bpe_49k.json"))
    assert not splits_at_spaces(read("byte_bpe_50k.json"))
    other = Encoder(public_tokenizers.path("byte_bpe_50k.json"), 50)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["two  spaces and\na line", "Words word words,", "", " x"]
    for got, t in zip(other.encode_all([t.encode() for t in texts]), texts):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_many_texts_at_once_and_a_small_memory():
    encoder = Encoder(word_tokenizer(), 20)
    texts = [text(i, i) + (" <|endoftext|>" if i % 5 == 0 else ",") for i in range(40)] * 2
    for got, t in zip(encoder.encode_all([t.encode() for t in texts]), texts):
        assert np.frombuffer(got, "<u4").tolist() == ids_of(t)[:-1]
    assert len(encoder.known) <= 20


def test_the_very_long_word_is_packed_too(docs):
    rows = [(906, "x" * 200_000), (1, "a b c")]
    check(rows, pack(docs(*rows), PackParams(word_tokenizer())).collect(), 2048)
