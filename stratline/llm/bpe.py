"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

The encoder never runs merges over a word. A token sequence is the result of the merge list
exactly when all its neighbouring tokens are stable (`Merges.neighbours`), so the last token
of every prefix is unique and follows from the prefixes before it. A later token can begin
only where the rest of the input is the start of some token, thus at most `lookahead`
symbols (the longest token of the merge list, less one) before the end. Tokens on which the
paths to all those places agree are final: they are emitted and forgotten, and the memory
for a word of any length stays constant. Equal words are answered from a bounded cache.

The decoder feeds the pieces of the ids to an incremental byte-to-text state machine, so a
character that is split between two tokens waits for its last byte.

Null and empty texts have no tokens; their decoded text is empty. Repeated rows give equal
results; other columns are not looked at.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import math
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from stratline.llm import texts

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
# The white space of the tokenizer's \s, its word pattern, its byte letters.
WHITE = regex.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^ \p{L}\p{N}]+")
# Of digests(), which runs where earlier stages have left little room: words in the cache, and
# characters encoded at once.
CACHED_WORDS, STEP = 200_000, 1 << 20
OTHER_SPACE = regex.compile("[\x1c-\x1f]")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {b: b for b in PRINTABLE} | {b: 256 + i for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merge list, with the tests that the transducer needs."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        ids: dict[str, int] = model["vocab"]
        self.pieces = {i: t for t, i in chain(ids.items(), self.special.items())}
        size = max(self.pieces) + 1
        self.left, self.right = [-1] * size, [-1] * size
        self.born = [-1] * size  # the rank of the merge that makes a token
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, both = ids[a], ids[b], ids[a + b]
            if max(self.born[a], self.born[b]) >= rank:
                raise ValueError("a merge uses a token that a later merge makes")
            self.pairs[a, b] = rank
            self.left[both], self.right[both], self.born[both] = a, b, rank
        self.stable: dict[tuple[int, int], bool] = {}
        self.moves: dict[tuple[str, str], str] = {}
        self.ends: dict[str, tuple[tuple[int, int], ...]] = {}
        self.last: dict[tuple[str, str], tuple[tuple[int, int], ...]] = {}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.starts: set[str] = set()
        for token, i in ids.items():
            if not self.whole(i):
                continue
            ends = bool(self.suffix) and token.endswith(self.suffix) and token != self.suffix
            text = token[: -len(self.suffix)] if ends else token
            (self.final if ends else self.inner)[text] = i
            self.starts.update(text[:k] for k in range(1, len(text) + (not ends)))
        if not self.suffix:
            self.final = self.inner
        self.longest = max(map(len, chain(self.inner, self.final)))
        self.lookahead = self.longest - 1

    def whole(self, token: int) -> bool:
        """Whether the merges of a token's own symbols end in the token."""
        if self.born[token] < 0:
            return True
        a, b, rank = self.left[token], self.right[token], self.born[token]
        return self.whole(a) and self.whole(b) and self.apart(a, b, rank, rank)

    def apart(self, a: int, b: int, until_a: float, until_b: float) -> bool:
        """Go back through the merges of both tokens and look at each pair that ever met at
        their border: a pair with a merge of its own would have joined first if its rank
        came before the merges that took up either part. At equal ranks the left merge is
        first."""
        while True:
            rank = self.pairs.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if self.born[a] < 0 and self.born[b] < 0:
                return True
            if self.born[b] >= self.born[a]:
                until_b, b = self.born[b], self.left[b]
            else:
                until_a, a = self.born[a], self.right[a]

    def following(self, state: str, symbol: str) -> str:
        """Transition: the longest end of state + symbol that begins a token."""
        key = (state, symbol)
        known = self.moves.get(key)
        if known is None:
            if len(self.moves) > 250_000:
                self.moves.clear()
            known = state + symbol
            while known and known not in self.starts:
                known = known[1:]
            self.moves[key] = known
        return known

    def inner_ends(self, state: str) -> tuple[tuple[int, int], ...]:
        """(size, token) of the tokens that end where a state ends, longest first."""
        known = self.ends.get(state)
        if known is None:
            sizes = range(len(state), 0, -1)
            known = self.ends[state] = tuple((n, self.inner[state[-n:]]) for n in sizes if state[-n:] in self.inner)
        return known

    def final_ends(self, state: str, symbol: str) -> tuple[tuple[int, int], ...]:
        key = (state, symbol)
        known = self.last.get(key)
        if known is None:
            if len(self.last) > 250_000:
                self.last.clear()
            text = state + symbol
            sizes = range(len(text), 0, -1)
            known = self.last[key] = tuple((n, self.final[text[-n:]]) for n in sizes if text[-n:] in self.final)
        return known

    def neighbours(self, a: int, b: int) -> bool:
        """Whether token b can stand after token a in a result of the merge list."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) > 400_000:
                self.stable.clear()
            known = self.stable[a, b] = self.apart(a, b, math.inf, math.inf)
        return known


class Encoder:
    """Transducer for one word: feed symbols, get final tokens as soon as they are final."""

    def __init__(self, merges: Merges, flush: int = 64):
        self.m, self.flush = merges, max(flush, merges.longest)
        self.reset()

    def reset(self) -> None:
        self.symbols = ""
        self.state = ""  # the longest end of the input that begins a token
        self.before = -1  # the last token already emitted
        self.tokens: list[int] = []  # the last token of each pending prefix
        self.sizes: list[int] = []

    def step(self, choices: tuple[tuple[int, int], ...]) -> None:
        """Find the last token of the prefix that ends here among the tokens that end here."""
        tokens, known = self.tokens, self.m.stable
        end = len(tokens) + 1
        for size, token in choices:
            previous = tokens[end - size - 1] if size < end else self.before
            if previous >= 0:
                fits = known.get((previous, token))
                if fits is None:
                    fits = self.m.neighbours(previous, token)
                if not fits:
                    continue
            tokens.append(token)
            self.sizes.append(size)
            return
        raise ValueError("no token for a symbol")

    def path(self, end: int) -> list[int]:
        """Ends of the tokens on the way to a place, last first."""
        out = []
        while end > 0:
            out.append(end)
            end -= self.sizes[end - 1]
        return out

    def settled(self) -> int:
        """The last place through which every way that can still go on has to come."""
        end = len(self.symbols)
        alive = [end] + [j for j in range(max(0, end - self.m.lookahead), end) if self.symbols[j:] in self.m.starts]
        common = set(self.path(alive[0]))
        for place in alive[1:]:
            common &= set(self.path(place))
        return max(common, default=0)

    def emit(self, end: int) -> list[int]:
        out = [self.tokens[k - 1] for k in reversed(self.path(end))]
        if end:
            self.before = self.tokens[end - 1]
            self.symbols = self.symbols[end:]
            self.tokens, self.sizes = self.tokens[end:], self.sizes[end:]
        return out

    def feed(self, symbols: str) -> Iterator[int]:
        """Symbols that are not the last of their word."""
        m = self.m
        for symbol in symbols:
            self.symbols += symbol
            self.state = m.following(self.state, symbol)
            self.step(m.inner_ends(self.state))
            if len(self.symbols) >= self.flush and len(self.symbols) % self.flush == 0:
                yield from self.emit(self.settled())

    def finish(self, symbol: str) -> Iterator[int]:
        """The last symbol of the word, which carries the end-of-word mark."""
        self.symbols += symbol
        self.step(self.m.final_ends(self.state, symbol))
        yield from self.emit(len(self.symbols))
        self.reset()


class Lanes:
    """The same transducer for many words side by side, one symbol of each at a time.

    Transitions, the tokens that end in a state and the merge list are arrays, so a step is
    a handful of array look-ups for all words that are still running.
    """

    def __init__(self, merges: Merges):
        letter = byte_letters()
        byte = {chr(c): b for b, c in letter.items()}
        states = ["", *sorted(merges.starts)]
        number = {s: k for k, s in enumerate(states)}
        self.depth = np.array([len(s) for s in states])
        self.fail, self.link = np.zeros(len(states), np.int64), np.zeros(len(states), np.int64)
        self.token = np.array([merges.inner.get(s, -1) for s in states])
        for k, s in sorted(enumerate(states), key=lambda x: len(x[1])):
            if len(s) > 1:
                shorter = s[1:]
                while shorter not in number:
                    shorter = shorter[1:]
                self.fail[k] = f = number[shorter]
                self.link[k] = f if self.token[f] >= 0 else self.link[f]
        edges = [(number[s[:-1]] << 8 | byte[s[-1]], k) for k, s in enumerate(states) if s]
        self.edge, self.child = texts.Vocabulary(self.key([e for e, _ in edges])), np.array([k for _, k in edges])
        ends = [(number[s[:-1]] << 8 | byte[s[-1]], t) for s, t in merges.final.items()]
        self.end, self.ending = texts.Vocabulary(self.key([e for e, _ in ends])), np.array([t for _, t in ends])
        self.pair = texts.Vocabulary(self.key([a << 20 | b for a, b in merges.pairs]))
        self.left, self.right, self.born = (np.array(x) for x in (merges.left, merges.right, merges.born))
        self.met = np.full(1 << 20, -1)  # the last pair of each slot, and whether it can stand so
        source, byte_of = np.array([e >> 8 for e, _ in edges]), np.array([e & 255 for e, _ in edges])
        # Moves by the most frequent symbols are a table; others go down the failure links.
        frequent = np.argsort(-np.bincount(byte_of, minlength=256), kind="stable")[:32]
        self.column = np.full(256, -1)
        self.column[frequent] = np.arange(len(frequent))
        self.goto = np.zeros((len(states), len(frequent)), np.int32)
        tabled = self.column[byte_of] >= 0
        source, byte_of, target = source[tabled], byte_of[tabled], self.child[tabled]
        for deep in range(int(self.depth.max(initial=0)) + 1):
            if deep:
                level = np.flatnonzero(self.depth == deep)
                self.goto[level] = self.goto[self.fail[level]]
            here = self.depth[source] == deep
            self.goto[source[here], self.column[byte_of[here]]] = target[here]

    @staticmethod
    def key(numbers) -> np.ndarray:
        return texts.mix(np.asarray(numbers, np.uint64) + np.uint64(1))

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merges.neighbours for many pairs."""
        pair = a << 20 | b
        slot = ((pair.astype(np.uint64) * texts.STEP) >> np.uint64(44)).astype(np.int64)
        known = self.met[slot]
        out = (known & 1).astype(bool)
        new = np.flatnonzero(known >> 1 != pair)
        if len(new):
            out[new] = self.apart(a[new], b[new])
            self.met[slot[new]] = pair[new] << 1 | out[new]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        until_a = np.full(len(a), 1 << 40)
        until_b = until_a.copy()
        open_ = np.arange(len(a))
        while len(open_):
            rank = self.pair.find(self.key(a << 20 | b))
            joined = (rank >= 0) & (rank < until_a) & (rank <= until_b)
            out[open_[joined]] = False
            born_a, born_b = self.born[a], self.born[b]
            go = ~joined & ((born_a >= 0) | (born_b >= 0))
            back_b = born_b >= born_a
            until_a, until_b = np.where(back_b, until_a, born_a)[go], np.where(back_b, born_b, until_b)[go]
            a, b = np.where(back_b, a, self.right[a])[go], np.where(back_b, self.left[b], b)[go]
            open_ = open_[go]
        return out

    def move(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        column = self.column[symbol]
        out = self.goto[state, column].astype(np.int64)  # column -1: found below
        open_ = np.flatnonzero(column < 0)
        out[open_], state, symbol = 0, state[open_], symbol[open_]
        while len(open_):
            got = self.edge.find(self.key(state << 8 | symbol))
            there = got >= 0
            out[open_[there]] = self.child[got[there]]
            again = ~there & (state > 0)
            open_, symbol, state = open_[again], symbol[again], self.fail[state[again]]
        return out

    def settle(self, at, lanes, sizes, tokens, found, size) -> np.ndarray:
        """Note the tokens that may stand after what comes before them; tell which may not."""
        before = np.where(size <= at, tokens[lanes, np.maximum(at - size, 0)], -1).astype(np.int64)
        fits = before < 0
        fits[~fits] = self.neighbours(before[~fits], found[~fits])
        tokens[lanes[fits], at], sizes[lanes[fits], at] = found[fits], size[fits]
        return ~fits

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word; the words must not be empty."""
        sizes, ids = self.encoded(words)
        ends = np.cumsum(sizes).tolist()
        return [ids[end - n : end].tolist() for n, end in zip(sizes.tolist(), ends)]

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each word, and the tokens end to end."""
        given = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-given, kind="stable")
        length = given[order]
        longest = int(length[0]) if len(length) else 0
        symbols = np.zeros((len(words), longest), np.uint8)
        symbols[np.arange(longest) < length[:, None]] = np.frombuffer(b"".join([words[k] for k in order.tolist()]), np.uint8)
        tokens, sizes = np.full((len(words), longest), -1, np.int32), np.zeros((len(words), longest), np.int32)
        state = np.zeros(len(words), np.int64)
        for at in range(longest):
            running = int(np.searchsorted(-length, -(at + 1), "left"))  # more symbols follow
            last = int(np.searchsorted(-length, -at, "left"))
            # Lanes that end here: tokens with the end mark, from the longest on.
            wait, place = np.arange(running, last), state[running:last].copy()
            while len(wait):
                got = self.end.find(self.key(place << 8 | symbols[wait, at]))
                there = got >= 0
                stay = ~there
                stay[there] = self.settle(at, wait[there], sizes, tokens, self.ending[got[there]], self.depth[place[there]] + 1)
                wait, place = wait[stay], self.fail[place[stay]]
            # Lanes that go on.
            state[:running] = node = self.move(state[:running], symbols[:running, at])
            wait = np.arange(running)
            node = np.where(self.token[node] >= 0, node, self.link[node])
            while len(wait):
                stay = self.settle(at, wait, sizes, tokens, self.token[node], self.depth[node])
                wait, node = wait[stay], self.link[node[stay]]
        # Back from the last symbol of every lane, a token of each at a time.
        back, lane, at = [], np.arange(len(words)), length - 1
        number = np.zeros(len(words), np.int64)
        while len(lane):
            back.append((lane, tokens[lane, at]))
            number[lane] += 1
            at = at - sizes[lane, at]
            lane, at = lane[at >= 0], at[at >= 0]
        found = np.zeros(len(words), np.int64)
        found[order] = number
        last = np.cumsum(found)[order] - 1
        ids = np.zeros(int(found.sum()), np.int32)
        for step, (lane, token) in enumerate(back):
            ids[last[lane] - step] = token
        return found, ids


def running(counts: np.ndarray) -> np.ndarray:
    """Running total with a leading zero."""
    return np.concatenate(([0], np.cumsum(counts)))


class Known:
    """Ids of words, end to end in arrays, with the place of every word."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ends, self.ids = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32)
        self.rows = 0  # the first end is 0

    def __len__(self) -> int:
        return self.rows

    def add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        used = int(self.ends[self.rows])
        to, end = self.rows + len(words), used + len(ids)
        if to >= len(self.ends):
            self.ends = np.resize(self.ends, 2 * to)
        if end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * end)
        self.ends[self.rows + 1 : to + 1] = used + np.cumsum(sizes)
        self.ids[used:end] = ids
        self.place.update(zip(words, range(self.rows, to)))
        self.rows = to

    def places(self, words: Iterable[str], count: int) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, words), np.int64, count)

    def of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of the words at some places, and the ids end to end."""
        first = self.ends[place]
        sizes = self.ends[place + 1] - first
        ends = np.cumsum(sizes)
        at = np.repeat(first - ends + sizes, sizes)
        at += np.arange(len(at))
        return sizes, self.ids[at]


class Tokenizer:
    """Texts to ids and back."""

    def __init__(self, content: str, cached_words: int = 400_000, longest_lane: int = 64):
        self.merges = Merges(content)
        self.encoder = Encoder(self.merges)
        self.letters = byte_letters()
        self.lanes = Lanes(self.merges)
        self.cached_words, self.longest_lane = cached_words, longest_lane
        # Two generations: a full cache becomes the older one, and what is used moves on.
        self.known, self.older = Known(), Known()
        marks = sorted(self.merges.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.piece = {i: t.encode() for i, t in self.merges.pieces.items()}

    def learn(self, chunks: set[str]) -> None:
        """Put the ids of texts without white space into the cache; no word of the pattern
        reaches beyond one, and a word is a text that the pattern leaves whole."""
        fresh, parts = [], {}
        for chunk in self.unknown(chunks):
            if chunk.isascii() and chunk.isalpha():
                fresh.append(chunk)
            else:
                parts[chunk] = WORD.findall(chunk)
        fresh += self.unknown(set(chain.from_iterable(parts.values())).difference(fresh))
        as_bytes = [w.encode() for w in fresh]
        short = [k for k, b in enumerate(as_bytes) if len(b) <= self.longest_lane]
        for at in range(0, len(short), 60_000):
            some = short[at : at + 60_000]
            self.known.add([fresh[k] for k in some], *self.lanes.encoded([as_bytes[k] for k in some]))
        for word, found in zip(fresh, as_bytes):
            if len(found) > self.longest_lane:
                symbols = found.decode("latin-1").translate(self.letters)
                ids = [*self.encoder.feed(symbols[:-1]), *self.encoder.finish(symbols[-1])]
                self.known.add([word], np.array([len(ids)]), np.array(ids, np.int32))
        parts = {chunk: found for chunk, found in parts.items() if found != [chunk]}
        counts = np.fromiter(map(len, parts.values()), np.int64, len(parts))
        sizes, ids = self.known.of(self.known.places(chain.from_iterable(parts.values()), int(counts.sum())))
        self.known.add([*parts], np.diff(running(sizes)[running(counts)]), ids)

    def unknown(self, some: set[str]) -> set[str]:
        """Those without ids so far; what only the older cache knows is taken over."""
        new = some.difference(self.known.place)
        rest = new.difference(self.older.place)
        old = [*new.difference(rest)]
        self.known.add(old, *self.older.of(self.older.places(old, len(old))))
        return rest

    def folded(self, text: str) -> str:
        """Lower case, with words that white space of ASCII parts."""
        ascii_ = text.isascii()
        if not ascii_:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # str.split() also cuts at four separators that are no white space to the tokenizer.
        if OTHER_SPACE.search(text):
            return " ".join(WHITE.split(text))
        return text if ascii_ else " ".join(text.split())

    def encode_all(self, some: Iterable[str], step: int = 1 << 21) -> Iterator[list[int]]:
        """Ids of each text, about step characters at a time."""
        return (ids.tolist() for ids in self.arrays(some, step))

    def arrays(self, some: Iterable[str], step: int = 1 << 21) -> Iterator[np.ndarray]:
        """encode_all, with arrays."""
        waiting, size = [], 0
        for text in some:
            waiting.append(text)
            size += len(text)
            if size >= step:
                yield from self.encode_step(waiting)
                waiting, size = [], 0
        yield from self.encode_step(waiting)

    def encode_step(self, some: list[str]) -> Iterator[np.ndarray]:
        marked = [self.marks.split(t) if self.marks and "<" in t else [t] for t in some]
        plain = [self.folded(part) for parts in marked for part in parts[::2]]
        # Arrow splits and numbers the words; only different ones become strings of Python.
        lists = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        words = lists.flatten().dictionary_encode()
        counts = lists.offsets.to_numpy()
        different = words.dictionary.to_pylist()
        if len(self.known) > self.cached_words:
            self.older, self.known = self.known, Known()
        place = np.fromiter(map(self.known.place.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(place < 0)
        if len(new):
            some = [different[k] for k in new.tolist()]
            self.learn(set(some))
            place[new] = self.known.places(some, len(some))
        sizes, ids = self.known.of(place[words.indices.to_numpy()])
        cuts = running(sizes)[counts].tolist()
        pieces = (ids[a:b] for a, b in zip(cuts, cuts[1:]))
        for parts in marked:
            if len(parts) == 1:
                yield next(pieces)
            else:
                special = self.merges.special
                yield np.concatenate([np.array([special[part]], np.int32) if k % 2 else next(pieces) for k, part in enumerate(parts)])

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of the ids, piece by piece as its characters are complete."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        ids, size, first = list(ids), 4096, True
        for at in range(0, len(ids), size):
            step = b" ".join([self.piece[i] for i in ids[at : at + size]])
            yield machine.decode(step if first else b" " + step)
            first = False
        yield machine.decode(b"", True)


def tokenizer(content: str, **bounds: int) -> Tokenizer:
    """The worker's tokenizer for a vocabulary file; its word cache serves all tasks of a stage."""
    key = f"{hashlib.md5(content.encode()).hexdigest()} {bounds}"
    if key not in texts.kept:
        texts.kept.clear()
        texts.kept[key] = Tokenizer(content, **bounds)
    return texts.kept[key]


def vocabulary(path: str, limit: int = 64 << 20) -> str:
    """Content of a vocabulary file, read by the driver for a broadcast of bounded size."""
    with open(path, encoding="utf-8") as file:
        content = file.read(limit + 1)
    if len(content) > limit:
        raise ValueError(f"{path} is larger than {limit} characters")
    return content


def digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Encode every text, decode the ids, and return counts and digests of both."""
    content = docs.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(content.value, cached_words=CACHED_WORDS)
        number = {i: str(i) for i in coder.piece}
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for ids in coder.encode_all(texts.values(texts.column(batch, "text")), STEP):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join([number[i] for i in ids]).encode()).hexdigest())
                decoded = hashlib.sha256()
                for part in coder.decode(ids):
                    decoded.update(part.encode())
                text_sha.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
