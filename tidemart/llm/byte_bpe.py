"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A text is split into matches of a pattern; in each, the adjacent pair whose joined bytes
have the lowest rank is merged until no pair has one (a match that is a token as a whole is that token).
Two facts turn this into reading from left to right. A sequence of tokens is the encoding of its bytes
if each adjacent two are (`Merges.adjoin`: no merge across their border comes before the merges that
take the border's parts away). And the encoding of a prefix is that of a shorter prefix with one token
more. A state holds the prefixes that may still be continued: for each, its last token, the prefix
it continues and the place in the trie of tokens that the bytes since then have reached. Reading a
byte steps the places and adds the one prefix that ends here; prefixes that nothing can continue
are dropped, and tokens that all remaining ones agree on are emitted: at most the longest token's bytes
are looked ahead. States and steps are made when first met and kept in a bounded table, as is the
output of whole matches (a single step from start to end); a full table is begun anew.

Decoding. Token ids in blocks of any size give the bytes of complete characters; a character that a
block cuts waits for the next. The UTF-8 state machine is lifted from bytes to tokens (state x token
-> state, one table made by numpy), so only tokens that end inside a character are walked.

Defined cases: null text is empty; an empty text has no ids. Long texts are worked on in blocks of
matches, a long match (no spaces) takes linear time. Repeated rows come out each. An empty table gives
no rows. doc_id is a whole number or null, passed through. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemart.llm.common import to_batch


@dataclass(frozen=True)
class BpeParams:
    ranks: str  # path of a file of ranks (base64 of the token's bytes, rank), read on the driver
    pattern: str
    #: steps of the transducer a process keeps
    steps: int = 200_000
    #: words (what follows a space up to the next) whose ids a process keeps, and as many other matches
    words: int = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Ranks compiled: each token's last merge, and the trie of tokens. Small: a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte has to be a token")
        self.ranks, self.token = ranks, {r: t for t, r in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        #: tokens that merging their own bytes gives; others occur as whole matches only
        self.reached = {r for t, r in ranks.items() if len(t) == 1}
        #: tokens all of whose merges come in the order of their ranks
        self.ordered = set(self.reached)
        for t, r in sorted(ranks.items(), key=lambda x: len(x[0])):
            if len(t) > 1 and (parts := self.merge(t, 2)) and len(parts) == 2:
                a, b = parts
                self.halves[r] = a, b
                self.reached.add(r)
                if a in self.ordered and b in self.ordered and r > max(a, b):
                    self.ordered.add(r)
        self.child: dict[int, int] = {}
        self.merged, self.whole = [-1], [-1]  # of each trie node: token that merging gives, any token
        for t, r in ranks.items():
            node = 0
            for b in t:
                at = node << 8 | b
                if at not in self.child:
                    self.child[at] = len(self.whole)
                    self.merged.append(-1)
                    self.whole.append(-1)
                node = self.child[at]
            self.whole[node] = r
            self.merged[node] = r if r in self.reached else -1
        self.longest = max(map(len, ranks))
        #: of each token, the longest shorter one that it begins with
        self.shorter = {r: max((ranks[t[:k]] for k in range(1, len(t)) if ranks.get(t[:k]) in self.reached),
                               key=lambda x: len(self.token[x]), default=-1) for t, r in ranks.items()}

    def merge(self, data: bytes, least: int = 1) -> list[int]:
        """Merge pair by pair until none is left, or ``least`` parts are. Quadratic: for short data."""
        parts = [bytes([b]) for b in data]
        while len(parts) > least:
            rank, at = min(
                ((self.ranks[j], i) for i in range(len(parts) - 1) if (j := parts[i] + parts[i + 1]) in self.ranks),
                default=(-1, -1))
            if rank < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if least == 2 and len(parts) == 2 and parts[0] + parts[1] not in self.ranks:
            return []
        return [self.ranks[p] for p in parts]

    def adjoin(self, a: int, b: int) -> bool:
        """Is (a, b) the encoding of its bytes, a and b being tokens that merging gives?"""
        if a not in self.ordered or b not in self.ordered:
            return self.merge(self.token[a] + self.token[b]) == [a, b]
        # undo the merges on both sides of the border, the latest first; a part lives until `until`
        token, ranks, halves = self.token, self.ranks, self.halves
        until_a = until_b = 1 << 62
        while True:
            rank = ranks.get(token[a] + token[b])
            # of equal ranks, the one further left is merged first
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if a in halves and (a > b or b not in halves):  # of two alike, the right one came last
                until_a, a = a, halves[a][1]
            elif b in halves:
                until_b, b = b, halves[b][0]
            else:
                return True


class Transducer:
    """Bytes to token ids, step by step; see the module's description."""

    def __init__(self, merges: Merges, steps: int):
        self.merges, self.steps = merges, steps
        self.joined: dict[int, bool] = {}
        self.states: list[bytes] = []
        self.number: dict[bytes, int] = {}
        self.ends: dict[int, tuple[int, ...]] = {}
        self.step: dict[int, int] = {}  # state and byte -> next state, or below 0: an entry of emitted
        self.emitted: list[tuple[int, tuple[int, ...]]] = []
        self.start = self._state([-1], [-1], [0])

    def _state(self, last: list[int], before: list[int], place: list[int]) -> int:
        """Prefixes by length: last token, index of the prefix it continues, trie node or -1."""
        packed = array("i", last + before + place).tobytes()
        number = self.number.setdefault(packed, len(self.states))
        if number == len(self.states):
            self.states.append(packed)
        return number

    def _prefixes(self, state: int) -> tuple[list[int], list[int], list[int]]:
        packed = array("i", self.states[state]).tolist()
        n = len(packed) // 3
        return packed[:n], packed[n : 2 * n], packed[2 * n :]

    def _adjoin(self, a: int, b: int) -> bool:
        pair = a << 32 | b
        found = self.joined.get(pair)
        if found is None:
            if len(self.joined) > self.steps:
                self.joined.clear()
            found = self.joined[pair] = self.merges.adjoin(a, b)
        return found

    def _make(self, state: int, byte: int) -> int:
        child, merged = self.merges.child, self.merges.merged
        last, before, place = self._prefixes(state)
        n, up, token = len(last), -1, -1
        for i in range(n):
            if place[i] >= 0:
                to = place[i] = child.get(place[i] << 8 | byte, -1)
                # the longest token that ends here and adjoins: there is exactly one
                if up < 0 <= to and (t := merged[to]) >= 0 and (last[i] < 0 or self._adjoin(last[i], t)):
                    up, token = i, t
        last.append(token)
        before.append(up)
        place.append(0)
        last, before, place, out = self._settled(last, before, place)
        after = self._state(last, before, place)
        if out:
            self.emitted.append((after, tuple(out)))
            after = -len(self.emitted)
        self.step[state << 8 | byte] = after
        return after

    @staticmethod
    def _settled(last: list[int], before: list[int], place: list[int]):
        """Without the prefixes that nothing goes on from, and the tokens all others agree on."""
        n = len(last)
        # how many of those that go on continue each prefix, and the latest of them
        follow, latest = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            if place[i] >= 0 or follow[i]:
                follow[before[i]] += 1
                latest[before[i]] = i
        root, out = 0, []
        while place[root] < 0 and follow[root] == 1:
            root = latest[root]
            out.append(last[root])
        kept = [i for i in range(root, n) if i == root or place[i] >= 0 or follow[i]]
        moved = {k: i for i, k in enumerate(kept)}
        return ([last[i] for i in kept], [-1] + [moved[before[i]] for i in kept[1:]], [place[i] for i in kept], out)

    @staticmethod
    def _path(last: list[int], before: list[int]) -> list[int]:
        """Tokens from the first prefix to the last."""
        path, i = [], len(last) - 1
        while i > 0:
            path.append(last[i])
            i = before[i]
        path.reverse()
        return path

    def _end(self, state: int) -> tuple[int, ...]:
        last, before, place = self._prefixes(state)
        whole = self.merges.whole[place[0]] if last[0] < 0 and place[0] > 0 else -1
        if whole >= 0:
            out = [whole]
        else:
            out = self._path(last, before)
        self.ends[state] = tuple(out)
        return self.ends[state]

    def encode(self, match: bytes) -> list[int]:
        state, step, out = self.start, self.step, []
        for byte in match:
            after = step.get(state << 8 | byte)
            if after is None:
                if len(step) >= self.steps:
                    return self._search(match, out)
                after = self._make(state, byte)
            if after < 0:
                after, tokens = self.emitted[-1 - after]
                out += tokens
            state = after
        end = self.ends.get(state)
        out += self._end(state) if end is None else end
        return out

    def _search(self, match: bytes, out: list[int]) -> list[int]:
        """The one sequence of adjoining tokens that goes on from ``out``, found without making states: the
        longest token first, a shorter one where it leads nowhere; ends that lead nowhere are tried once."""
        m = self.merges
        if not out and (whole := m.ranks.get(match)) is not None:
            return [whole]
        child, merged, joined, shorter, token_bytes = m.child, m.merged, self.joined, m.shorter, m.token
        dead: set[int] = set()
        token, n, a = -1, len(match), out[-1] if out else -1
        at = sum(len(token_bytes[t]) for t in out)
        while True:
            if token < 0:  # the longest one from here
                node = 0
                for byte in match[at : at + m.longest]:
                    node = child.get(node << 8 | byte)
                    if node is None:
                        break
                    if merged[node] >= 0:
                        token = merged[node]
            end = at + len(token_bytes[token])
            if end not in dead and (
                    a < 0 or (j := joined.get(a << 32 | token)) or j is None and self._adjoin(a, token)):
                out.append(token)
                if end == n:
                    return out
                at, a, token = end, token, -1
                continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                token = out.pop()
                at -= len(token_bytes[token])
                a = out[-1] if out else -1
                token = shorter[token]


#: Fixed value: a pattern in whose matches a space stands first or among white space only. So a match
#: ends before each space that follows no white space; texts are cut there first, and most of what comes
#: out has been met before. With other patterns every match is found one by one.
SPACE_OPENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD = re.compile(r"(?<=\S)(?= )")
RUN_BEFORE_SPACE = re.compile(r"\s ")


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, merges: Merges, params: BpeParams):
        import regex

        self.split = regex.compile(params.pattern)
        self.by_words = params.pattern == SPACE_OPENS
        self.transducer, self.most = Transducer(merges, params.steps), params.words
        #: ids of matches, and of what follows a space up to the next
        self.matches: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.new = 0

    def _match(self, match: str) -> bytes:
        known, key = (self.words, match[1:]) if match[0] == " " else (self.matches, match)
        ids = known.get(key)
        if ids is None:
            ids = self._encode(match)
            if len(known) < self.most and len(match) <= 40:
                known[key] = ids
        return ids

    def _encode(self, match: str) -> bytes:
        return array("I", self.transducer.encode(match.encode())).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word after its space: mostly letters, which are one match."""
        self.new += 1
        if self.new > 16 * self.most:  # texts have become others
            self.matches, self.words, self.new = {}, {}, 0
        if word.isalpha() and max(word) < "\u0250":  # letters in any version of Unicode
            ids = self._encode(" " + word)
        else:
            ids = b"".join(map(self._match, self.split.findall(" " + word)))
        if len(self.words) < self.most and len(word) <= 40:
            self.words[word] = ids
        return ids

    def _words(self, text: str) -> bytes:
        if RUN_BEFORE_SPACE.search(text):
            first, *words = WORD.split(text)
            words = [w[1:] for w in words]
        else:
            first, *words = text.split(" ")
        ids = list(map(self.words.get, words))
        if words and first == "":  # the text begins with a space: it is the first word's
            first_ids = b""
        else:
            first_ids = b"".join(map(self._match, self.split.findall(first)))
        at = -1
        try:
            while True:
                at = ids.index(None, at + 1)
                ids[at] = self._word(words[at])
        except ValueError:
            return first_ids + b"".join(ids)

    def blocks(self, text: str, size: int = 1 << 20) -> Iterator[bytes]:
        """The ids of a text in blocks of about so many characters, cut where matches end."""
        if len(text) <= size:
            yield self._words(text) if self.by_words else b"".join(map(self._match, self.split.findall(text)))
            return
        parts, held = [], 0
        for m in self.split.finditer(text):
            parts.append(self._match(m.group()))
            held += m.end() - m.start()
            if held > size:
                yield b"".join(parts)
                parts, held = [], 0
        yield b"".join(parts)


def _utf8_machine() -> np.ndarray:
    """state x byte -> state. 0: between characters; 1-3: so many bytes to come; 4-7: the byte after
    E0, ED, F0, F4, of which not all are allowed; 8: broken."""
    to = np.full((9, 256), 8, np.uint8)
    to[0, :0x80], to[0, 0xC2:0xE0], to[0, 0xE0:0xF0], to[0, 0xF0:0xF5] = 0, 1, 2, 3
    to[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    for state, low, high, after in ((1, 0x80, 0xC0, 0), (2, 0x80, 0xC0, 1), (3, 0x80, 0xC0, 2), (4, 0xA0, 0xC0, 1),
                                    (5, 0x80, 0xA0, 1), (6, 0x90, 0xC0, 2), (7, 0x80, 0x90, 2)):
        to[state, low:high] = after
    return to


UTF8 = _utf8_machine()


class DecodeTable:
    """Bytes of each id, and what each token does to each state of the UTF-8 machine."""

    def __init__(self, token: dict[int, bytes]):
        self.bytes = [token.get(i, b"") for i in range(max(token) + 1)]
        width = np.array([len(t) for t in self.bytes])
        padded = np.zeros((len(width), max(width)), np.uint8)
        for i, t in enumerate(self.bytes):
            padded[i, : len(t)] = np.frombuffer(t, np.uint8)
        self.lifted = np.repeat(np.arange(9, dtype=np.uint8)[:, None], len(width), axis=1)
        for k in range(padded.shape[1]):
            on = width > k
            self.lifted[:, on] = UTF8[self.lifted[:, on], padded[on, k]]
        self.rows = [row.tolist() for row in self.lifted]


class StreamDecoder:
    """Blocks of ids to complete characters. Broken bytes become U+FFFD in `text`, stay in `data`."""

    def __init__(self, table: DecodeTable):
        self.table, self.state, self.waiting = table, 0, b""

    def data(self, ids: np.ndarray) -> bytes:
        """Bytes of the characters completed by these ids; those of an open one wait."""
        if not len(ids):
            return b""
        got = self.waiting + b"".join(map(self.table.bytes.__getitem__, ids.tolist()))
        state = self._after(ids)
        if state == 8:  # broken: begin anew at the last byte that may open a character
            back = next((k for k in range(1, min(4, len(got)) + 1) if got[-k] & 0xC0 != 0x80), 0)
            state = 0
            for byte in got[len(got) - back :] if back else b"":
                state = int(UTF8[state, byte])
            state = 0 if state == 8 else state
        open_bytes = 0
        if state:
            open_bytes = next(k for k in range(1, 4) if got[-k] & 0xC0 != 0x80)
        self.state, self.waiting = state, got[len(got) - open_bytes :]
        return got[: len(got) - open_bytes]

    def _after(self, ids: np.ndarray) -> int:
        """State after these ids; from between characters, only tokens that open one are walked."""
        opens = np.flatnonzero(self.table.lifted[0][ids])
        state, at, rows = self.state, 0, self.table.rows
        while True:
            if state == 0:
                k = int(np.searchsorted(opens, at))
                if k == len(opens):
                    return 0
                at = int(opens[k])
            if at == len(ids) or state == 8:
                return state
            state = rows[state][ids[at]]
            at += 1

    def text(self, ids: np.ndarray) -> str:
        return self.data(ids).decode("utf-8", "replace")

    def finish(self) -> bytes:
        """The bytes of a character that never came to its end."""
        rest, self.state, self.waiting = self.waiting, 0, b""
        return rest


def encode_blocks(text: str, encoder: Encoder) -> Iterator[np.ndarray]:
    for block in encoder.blocks(text):
        yield np.frombuffer(block, "<u4")


def decode_blocks(blocks: Iterable[np.ndarray], table: DecodeTable) -> Iterator[bytes]:
    decoder = StreamDecoder(table)
    for ids in blocks:
        yield decoder.data(ids)
    yield decoder.finish()


def _coder(docs: DataFrame, params: BpeParams):
    """(merges, decode table) for the tasks, and a function that gives a process its encoder. What is
    sent is one vocabulary, whatever the corpus."""
    merges = Merges(read_ranks(params.ranks))
    return docs.sparkSession.sparkContext.broadcast((merges, DecodeTable(merges.token)))


def encode(docs: DataFrame, params: BpeParams) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit numbers."""
    sent = _coder(docs, params)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        encoder = Encoder(sent.value[0], params)
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                ids = [b"".join(encoder.blocks(t or "")) for t in part.column("text").to_pylist()]
                yield to_batch(schema, part.column("doc_id").cast(pa.int64()), [len(x) // 4 for x in ids], ids)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, params: BpeParams) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that are not UTF-8 become U+FFFD, a null stays null."""
    sent = _coder(encoded, params)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        table = sent.value[1]
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                texts = [
                    None if ids is None
                    else b"".join(decode_blocks([np.frombuffer(ids, "<u4")], table)).decode("utf-8", "replace")
                    for ids in part.column("ids").to_pylist()
                ]
                yield to_batch(schema, part.column("doc_id").cast(pa.int64()), texts)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, params: BpeParams) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded and decoded again block by block, so that
    a document of any length is held as its text and one block."""
    sent = _coder(docs, params)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches):
        merges, table = sent.value
        encoder = Encoder(merges, params)

        def digests(text: str) -> tuple[int, str, str]:
            n, of_ids, of_text, decoder = 0, hashlib.sha256(), hashlib.sha256(), StreamDecoder(table)
            for ids in encode_blocks(text, encoder):
                n += len(ids)
                of_ids.update(ids)
                of_text.update(decoder.data(ids))
            of_text.update(decoder.finish())
            return n, of_ids.hexdigest(), of_text.hexdigest()

        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows = [digests(t or "") for t in part.column("text").to_pylist()]
                yield to_batch(schema, part.column("doc_id").cast(pa.int64()), *zip(*rows))

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
