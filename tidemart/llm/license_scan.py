"""Licence notices by winnowed fingerprints and banded alignment.

Texts are read as words (runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased). Of
every `window` consecutive grams of `gram` words the one with the least hash is a fingerprint; a
run of gram + window - 1 words that a text shares with a template is sure to share one. Fingerprints of
the templates are an inverted index. Hits of a template that lie on nearby diagonals are one candidate,
which is aligned with the template, word by word, within a band around these diagonals. Reported are the
words matched, their share of the template (coverage) and where they stand in the text.

Defined cases: null or empty text has no findings. Candidates of one template that overlap are one
finding, the better; different templates may overlap. Templates shorter than gram + window - 1 words are
refused, as they could be missed. Repeated rows: findings each; an empty table: none. Only doc_id and
text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemart.llm.common import slices, to_batch
from tidemart.llm.grams import LOWER, runs, span_hashes, windows
from tidemart.llm.license_templates import TEMPLATES

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SCHEMA = ("doc_id long, license string, kind string, template int, matched long, coverage double, "
          "start long, end long, first_word long, last_word long")
FIELDS = [("doc_id", pa.int64()), ("license", pa.string()), ("kind", pa.string()), ("template", pa.int32()),
          ("matched", pa.int64()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64()),
          ("first_word", pa.int64()), ("last_word", pa.int64())]


@dataclass(frozen=True)
class ScanParams:
    gram: int = 3
    window: int = 2
    band: int = 6
    min_coverage: float = 0.75
    templates: tuple[tuple[str, str, str], ...] = TEMPLATES


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(start, end, document, hash) of each word."""
    starts, ends, doc = runs(WORD[data], offsets)
    return starts, ends, doc, span_hashes(LOWER[data], starts, ends)


def fingerprints(hashes: np.ndarray, doc: np.ndarray, params: ScanParams) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash, position of its first word) of the winnowed grams."""
    grams, at = windows(hashes, doc, params.gram)
    owner, n, w = doc[at], len(grams), params.window
    chosen = np.zeros(n, bool)
    if n >= w:
        begin = np.flatnonzero(owner[w - 1 :] == owner[: n - w + 1])
        seen = np.stack([grams[begin + k] for k in reversed(range(w))], axis=1)
        chosen[begin + w - 1 - np.argmin(seen, axis=1)] = True  # the last of equal ones
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    first = np.flatnonzero(first)
    size = np.diff(np.append(first, n))
    for a, k in zip(first[size < w], size[size < w]):
        chosen[a + k - 1 - int(np.argmin(grams[a : a + k][::-1]))] = True
    picked = np.flatnonzero(chosen)
    return grams[picked], at[picked]


class Templates:
    def __init__(self, params: ScanParams):
        self.params, self.words, hits = params, [], []
        for number, (_, _, text) in enumerate(params.templates):
            raw = np.frombuffer(text.encode(), np.uint8)
            _, _, doc, hashes = words_of(raw, np.array([0, len(raw)]))
            if len(hashes) < params.gram + params.window - 1:
                raise ValueError(f"template {number} has too few words for its fingerprints")
            self.words.append(hashes)
            # every gram of a template is indexed, so a text's fingerprints need not be the template's
            grams, at = windows(hashes, doc, params.gram)
            hits += [(int(g), number, int(p)) for g, p in zip(grams, at)]
        hits.sort()
        self.grams = np.array([h[0] for h in hits], np.uint64)
        self.places = [h[1:] for h in hits]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of grams that a template has, first and last place in the index)."""
        lo, hi = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        found = np.flatnonzero(hi > lo)
        return found, np.stack([lo[found], hi[found]], axis=1)


def candidates(hits: list[tuple[int, int, int]], sizes: list[int], band: int) -> list[tuple[int, int, int]]:
    """(template, least and largest diagonal) from (template, text position, template position).

    Hits of a template, by text position, belong together while both positions rise, their diagonals stay
    within the band of the last and the text positions within the template's length.
    """
    out: list[tuple[int, int, int]] = []
    open_: dict[int, list[list[int]]] = {}
    for template, at, place in sorted(hits, key=lambda h: (h[0], h[1], h[2])):
        diagonal = at - place
        for group in open_.setdefault(template, []):
            near = abs(diagonal - group[2]) <= band and at - group[3] <= sizes[template]
            if near and at > group[3] and place > group[4]:
                group[0], group[1] = min(group[0], diagonal), max(group[1], diagonal)
                group[2], group[3], group[4] = diagonal, at, place
                break
        else:
            live = [g for g in open_[template] if at - g[3] <= sizes[template]]
            out += [(template, g[0], g[1]) for g in open_[template] if at - g[3] > sizes[template]]
            open_[template] = [*live, [diagonal, diagonal, diagonal, at, place]]
    return out + [(t, g[0], g[1]) for t, groups in open_.items() for g in groups]


def align(text: list[int], template: list[int], low: int, high: int) -> tuple[int, int, int]:
    """(words matched, first and last matched word of the text) of the best local alignment.

    Text word i may meet template word j while low <= i - j <= high. A match counts 2, a word left
    out or in or exchanged costs 1.
    """
    width = high - low + 1
    score = [0] * (width + 1)  # of row j - 1, by i - j - low
    from_: list[list[int]] = []  # 0 stop, 1 match or exchange, 2 text word left over, 3 template word
    best, middle, off = (0, -1, -1), (width - 1) / 2, 0.0
    for j, word in enumerate(template):
        row, moves = [0] * (width + 1), [0] * width
        for d in range(width):
            i = j + low + d
            if i < 0 or i >= len(text):
                continue
            value, move = score[d] + (2 if text[i] == word else -1), 1
            if d > 0 and row[d - 1] - 1 > value:
                value, move = row[d - 1] - 1, 2
            if score[d + 1] - 1 > value:
                value, move = score[d + 1] - 1, 3
            if value > 0:
                row[d], moves[d] = value, move
                if value > best[0] or value == best[0] and abs(d - middle) < off:
                    best, off = (value, j, d), abs(d - middle)  # of equal ones the nearest to the middle
        from_.append(moves)
        score = row
    matched, first, last = 0, -1, -1
    _, j, d = best
    while j >= 0 and d >= 0 and d < width and (move := from_[j][d]):
        i = j + low + d
        if move == 1:
            if text[i] == template[j]:
                matched += 1
                first, last = i, i if last < 0 else last
            j -= 1
        elif move == 2:
            d -= 1
        else:
            j, d = j - 1, d + 1
    return matched, first, last


def findings(words: list[int], hits: list[tuple[int, int, int]], known: Templates) -> list[tuple[int, int, int, int]]:
    """(template, matched, first word, last word), of overlapping ones of a template the best."""
    params, out = known.params, []
    sizes = [len(w) for w in known.words]
    for template, low, high in candidates(hits, sizes, params.band):
        own = known.words[template].tolist()
        low, high = low - params.band, high + params.band
        begin, end = max(0, low), min(len(words), high + len(own))
        matched, first, last = align(words[begin:end], own, low - begin, high - begin)
        if matched >= params.min_coverage * len(own):
            out.append((template, matched, first + begin, last + begin))
    out.sort(key=lambda f: (f[0], -f[1], f[2]))
    kept: list[tuple[int, int, int, int]] = []
    for f in out:
        if not any(k[0] == f[0] and f[2] <= k[3] and k[2] <= f[3] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: (f[2], f[0]))


def scan(docs: DataFrame, params: ScanParams = ScanParams()) -> DataFrame:
    """One row per finding (SCHEMA); start and end are character offsets, end exclusive."""
    schema = pa.schema(FIELDS)

    def run(batches):
        known = Templates(params)
        for rows, data, offsets in slices(batches):
            starts, ends, doc, hashes = words_of(data, offsets)
            grams, at = fingerprints(hashes, doc, params)
            found, ranges = known.hits(grams)
            by_doc: dict[int, list[tuple[int, int, int]]] = {}
            begins = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offsets) - 1))])
            for k, (lo, hi) in zip(found, ranges):
                d = int(doc[at[k]])
                by_doc.setdefault(d, []).extend(
                    (t, int(at[k] - begins[d]), p) for t, p in known.places[lo:hi])
            ids, out = rows.column("doc_id").cast(pa.int64()).to_pylist(), []
            for d, hits in by_doc.items():
                own = slice(begins[d], begins[d + 1])
                found_here = findings(hashes[own].tolist(), hits, known)
                if not found_here:
                    continue
                raw = data[offsets[d] : offsets[d + 1]]
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                for template, matched, first, last in found_here:
                    name, kind, _ = params.templates[template]
                    out.append((
                        ids[d], name, kind, template, matched, matched / len(known.words[template]),
                        int(chars[starts[own][first] - offsets[d]]), int(chars[ends[own][last] - offsets[d]]), first, last))
            if out:
                yield to_batch(schema, *zip(*out))

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
