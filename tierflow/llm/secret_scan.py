"""Secrets in texts: fixed patterns, and a linear-chain conditional random field beside them.

The patterns find assignments, access keys and long hexadecimal strings. The field tags tokens as
secret begin, inside or outside (B, I, O) from their shape, the words and signs around them, and
features of the whole file, and is decoded by Viterbi. All words and signs of a text are one
chain, and each may have any tag. A position around which no stretch of other tags can gain against
O throughout is O on the best path; the path is searched between such positions, which is decoding
the whole chain. The field's spans are added where they meet no span of a pattern;
those of the patterns always stay.

The field is fitted on a bounded sample: ``sampled`` documents, smallest hash of the id first,
and in these on windows of two sorts. As they are: the ``NEAR`` tokens to either side of what the
patterns find and of tokens that look like it, and for each ``ONE_IN``-th document a window anywhere. And
with something planted, in every ``PLANT_IN``-th document: a made-up secret of a kind that the
patterns don't know (``KINDS_MADE``), some of several tokens, behind words that announce one, or
alone if its shape tells; or else what is easily taken for one: an address, a number, a file, a word
behind the same announcement. So the field learns more than the patterns say, and to spare what
real texts are full of. The first tag of a window follows the tag before it. The words around a token
are hidden in every other copy of a window about such a token, so that shape and surroundings each
learn to speak alone. A last step sets ``margin``, by which a secret has to win, to what spares the
windows as they are. Scanning reads every whole text in one pass without a shuffle.

Defined results: null and empty texts have no spans; spans count code points, end exclusive;
spans of different kinds may overlap and are all reported, by start and then in the order of
``KINDS``; a sample without any secret gives a field that tags nothing; repeated rows get a row
each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import arrow, parts

SPANS = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long")
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this drops the shorter ones only
NEEDED = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

Span = tuple[int, int, int]  # start, kind, end


def pattern_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans of the patterns by start and kind, and where their values lie."""
    spans, values = [], []
    if ":" in text or "=" in text:  # no match without; nor, below, without the letters
        lower = text.lower()
        for m in ASSIGN.finditer(text) if any(w in lower for w in NEEDED) else ():
            if len(m[2]) >= ASSIGN_LEAST:
                spans.append((m.start(), 0, m.end()))
                values.append(m.span(2))
    for kind, found in ((1, ACCESS.finditer(text) if "AKIA" in text else ()), (2, HEX.finditer(text))):
        for m in found:
            if kind == 2 or m.end() - m.start() >= ACCESS_LEAST:
                spans.append((m.start(), kind, m.end()))
                values.append(m.span())
    return sorted(spans), sorted(values)


# Words and signs, with the blank before them if there is one. A word may hold signs, but ends before
# brackets, quotes, marks of assignments and lists, and closing points.
TOKEN = re.compile(r"""\s?(?:[^\s=:,;"'`()\[\]{}<>.!?]+(?:[.!?]+[^\s=:,;"'`()\[\]{}<>.!?]+)*|\S)""")
# What the fit shall learn to tell from secrets: eight characters or more with a digit, or twenty of any kind.
ALIKE = re.compile(r"(?=.*[0-9]).{8,}|.{20,}", re.DOTALL)
NEAR, ONE_IN, LENGTH = 4, 4, 16
HASHED = 1 << 16
STATES = "BIO"
HEXADECIMAL = frozenset("0123456789abcdef")
FIRST = 3  # in place of the tag before: the text begins
FORBIDDEN = -1e4


def number(features: list[str]) -> list[int]:
    return [1 + zlib.crc32(f.encode("utf-8", "replace")) % (HASHED - 1) for f in features]


VARIETY = [0, *(int(2 * math.log2(k)) for k in range(1, 33))]  # of a word with so many different letters
REPEATED = [0.0, 0.0, *(k * math.log2(k) for k in range(2, 64))]


def entropy(token: str) -> float:
    n, signs = len(token), set(token)
    if len(signs) == n:
        return math.log2(n)
    repeated = 0.0
    for sign in signs:
        k = token.count(sign)
        if k > 1:
            repeated += REPEATED[k] if k < 64 else k * math.log2(k)
    return math.log2(n) - repeated / n


@lru_cache(1 << 14)
def shape_numbers(glued: bool, n: int, entropy2: int, hexadecimal: bool, digits: int, upper: int, lower: int,
                  classes: str, signs: int, word: bool) -> list[int]:
    kinds = f"u{upper > 0}{lower > 0}{digits > 0}"
    return number([f"n{min(12, int(2 * math.log2(n)))}", f"d{round(4 * digits / n)}", kinds, f"e{entropy2}", f"c{classes[:6]}",
                   f"k{min(6, len(classes) // 3)}", f"h{hexadecimal}", f"p{signs}", f"t{n in (32, 40, 64)}",
                   f"u{kinds}{entropy2 // 2}", f"l{glued}{min(n, 3)}{word}"])


CLASSES = str.maketrans({**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a"),
                         **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")})
BEYOND = re.compile(r"[^\x00-\x7f]")
DOUBLED = re.compile(r"(.)\1+")
JOINING = re.compile(r"[+/_.=-]")


def look(token: str) -> tuple[tuple, int, int]:
    """What a token looks like, as arguments of ``shape_numbers``; the number of its beginning; its code."""
    bare = token.lstrip()
    glued, n, hexadecimal, lower = len(bare) == len(token), len(bare), HEXADECIMAL.issuperset(bare), bare.lower()
    raw = lower.encode("utf-8", "replace")
    if bare.isalpha() and (bare == lower or bare.isascii() and bare[1:] == lower[1:]):  # words, without counting
        capital = bare != lower
        key = glued, n, VARIETY[min(len(set(lower)), 32)], hexadecimal, 0, int(capital), n - capital, "Aa" if capital else "a", 0, True
    else:
        kinds = bare.translate(CLASSES)
        if not bare.isascii():
            kinds = BEYOND.sub("a", kinds)
        key = (glued, n, int(2 * entropy(bare)), hexadecimal, kinds.count("0"), kinds.count("A"), kinds.count("a"),
               DOUBLED.sub(r"\1", kinds)[:21], min(3, bare.count(".")) + 1 if JOINING.search(bare) else 0, bare.isalnum())
    return key, 1 + zlib.crc32(raw[:4], 115) % (HASHED - 1), zlib.crc32(raw)


def shape(token: str) -> list[int]:
    """Features of a token's own characters, and whether a blank is before it."""
    key, begin, _ = look(token)
    return [*shape_numbers(*key), begin]


def file_features(text: str) -> list[str]:
    n = max(1, len(text))
    return [f"f{int(math.log2(n))}", f"g{min(4, int(200 * (text.count('=') + text.count('{')) / n))}",
            f"j{min(4, text.count('://'))}"]


EDGE = {"^": "  ^^", "$": "  $$"}  # before the first and after the last token; tokens have one blank before them at most
PLACES = (3, 5, 7, 11, 13)  # one, two and three before, one and two after
SHAPES, NEIGHBOURS, FILES = 12, len(PLACES) + 1, 3


def code(token: str) -> int:
    return look(token)[2]


def neighbours(b3, b2, b1, a1, a2) -> list:
    """Features from the codes, numbers or arrays, of the tokens around."""
    near = [1 + (c * place + place) % (HASHED - 1) for c, place in zip((b1, b2, b3, a1, a2), PLACES, strict=True)]
    return [*near, 1 + (31 * b2 + 17 * b1 + 1) % (HASHED - 1)]


@dataclass
class ChainModel:
    """Scores of features by tag, and of transitions; those of the tag B are less by ``margin`` in use."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros((HASHED, 3)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(3))
    margin: float = 0.0

    def decode(self, features: list[list[int]]) -> list[int]:
        """Tags of one chain by Viterbi."""
        return self.path(np.stack([self.emit[f].sum(0) for f in features]))

    def path(self, scores: np.ndarray, before: bool = False, after: bool = False) -> list[int]:
        """The best tags for the scores of a chain, or of a part that has an O before or after it."""
        best, back = scores[0] + (self.move[2] if before else self.start), []
        for row in scores[1:]:
            through = best[:, None] + self.move
            back.append(through.argmax(0))
            best = through.max(0) + row
        tags = [int((best + self.move[:, 2] if after else best).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def gains(self, scores: np.ndarray) -> np.ndarray:
        """For each position, at least what a run of other tags around it can gain against O throughout.

        A transition counts at the position it leads to, against that from O to O: with the best of those
        that lead to its tag. So a run gains no more than the sum of its positions, and the best sum of a
        stretch around each follows from running sums. Leaving the run counts if it can gain.
        """
        into = (self.move[:, :2] - self.move[2, 2]).max(0)
        most = scores[:, :2] + into
        most[0] = scores[0, :2] + self.start[:2] - self.start[2]
        total = np.concatenate([[0.0], np.cumsum(most.max(1))])
        around = np.maximum.accumulate(total[:0:-1])[::-1] - np.minimum.accumulate(total[:-1])
        return around + max(0.0, (self.move[:2, 2] - self.move[2, 2]).max())


class Tagger:
    """Tags whole texts, with bounded tables of the words seen."""

    def __init__(self, model: ChainModel, entries: int = 250_000) -> None:
        self.model, self.entries = model, entries
        self.emit = model.emit - model.emit[:, 2:]  # against the tag O
        self.margin = np.array([model.margin, 0.0, 0.0])
        self.clear()

    def clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.kinds: dict[tuple, np.ndarray] = {}
        self.own, self.codes = np.zeros((0, 3)), np.zeros(0, np.int64)
        self.add(EDGE.values())

    def add(self, tokens: Iterable[str]) -> None:
        new = [t for t in dict.fromkeys(tokens) if t not in self.seen]
        if new:
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new)), strict=True))
            need = len(self.seen)
            if need > len(self.codes):
                more = max(1024, need, 2 * len(self.codes)) - len(self.codes)
                self.own = np.concatenate([self.own, np.zeros((more, 3))])
                self.codes = np.concatenate([self.codes, np.zeros(more, np.int64)])
            keys, begins, codes = zip(*map(look, new), strict=True)
            for key in set(keys).difference(self.kinds):
                self.kinds[key] = self.emit[shape_numbers(*key)].sum(0)
            self.own[need - len(new):need] = np.array([self.kinds[key] for key in keys]) + self.emit[np.array(begins)]
            self.codes[need - len(new):need] = codes

    def scores(self, text: str, tokens: list[str]) -> np.ndarray:
        """What each tag of each token gains against O, without the transitions."""
        if len(self.seen) > self.entries:
            self.clear()
        self.add(tokens)
        ids = np.array([0, 0, 0, *map(self.seen.__getitem__, tokens), 1, 1])
        codes, n = self.codes[ids], len(tokens)
        out = self.own[ids[3:-2]] + (self.emit[number(file_features(text))].sum(0) - self.margin)
        for feature in neighbours(*(codes[at:at + n] for at in (0, 1, 2, 4, 5))):
            out += self.emit.take(feature, 0)
        return out

    def tags(self, text: str, tokens: list[str]) -> np.ndarray:
        """Tags of the whole text on the best path."""
        out = np.full(len(tokens), 2)
        if not tokens:
            return out
        scores = self.scores(text, tokens)
        open_ = self.model.gains(scores) >= -1e-9
        bounds = np.flatnonzero(np.diff(np.concatenate([[False], open_, [False]])))
        for a, b in bounds.reshape(-1, 2).tolist():
            out[a:b] = self.model.path(scores[a:b], a > 0, b < len(tokens))
        return out

    def spans(self, text: str) -> list[tuple[int, int]]:
        tags = self.tags(text, TOKEN.findall(text))
        if (tags == 2).all():
            return []
        out: list[tuple[int, int]] = []
        for m, tag in zip(TOKEN.finditer(text), tags.tolist(), strict=True):
            if tag == 0:
                out.append((m.end() - len(m[0].lstrip()), m.end()))
            elif tag == 1 and out:
                out[-1] = (out[-1][0], m.end())
        return out


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


GATHERED = 512  # windows whose tokens' weights are summed at once: bounds what a step holds


def fit_chain(examples: list[tuple[Sequence[Sequence[int]], Sequence[int], int]], steps: int = 100, rate: float = 0.1,
              penalty: float = 1e-4, length: int = LENGTH) -> ChainModel:
    """Maximum likelihood by forward-backward over all windows at once, with Adam steps.

    A window of more than ``length`` tokens is cut, each part after the tag before it.
    """
    examples = [(f[at:at + length], t[at:at + length], t[at - 1] if at else before)
                for f, t, before in examples for at in range(0, len(f), length)]
    model = ChainModel()
    model.move[2, 1] = model.start[1] = FORBIDDEN  # inside follows begin or inside only
    if not any(t != 2 for _, tags, _ in examples for t in tags):
        model.start[0] = model.move[2, 0] = FORBIDDEN
        return model
    n, width = len(examples), SHAPES + NEIGHBOURS + FILES
    index, tags, real = np.zeros((n, length, width), np.int64), np.full((n, length), 2), np.zeros((n, length), bool)
    before = np.array([b for _, _, b in examples])
    for i, (features, found, _) in enumerate(examples):
        for j, (f, t) in enumerate(zip(features, found, strict=True)):
            index[i, j, :len(f)], tags[i, j], real[i, j] = f, t, True
    parameters = [model.emit, model.move, model.start]
    free = [np.ones_like(p) for p in parameters]
    free[0][0] = 0
    free[1][2, 1] = free[2][1] = 0
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    rows = np.arange(n)
    for step in range(1, steps + 1):
        emit = np.concatenate([model.emit[index[at:at + GATHERED]].sum(2) for at in range(0, n, GATHERED)])
        forward = np.zeros((n, length, 3))
        forward[:, 0] = np.vstack([model.move, model.start])[before] + emit[:, 0]
        for j in range(1, length):
            through = logsumexp(forward[:, j - 1, :, None] + model.move, 1) + emit[:, j]
            forward[:, j] = np.where(real[:, j, None], through, forward[:, j - 1])
        total = logsumexp(forward[:, -1], 1)
        backward = np.zeros((n, length, 3))
        gradient = [np.zeros_like(p) for p in parameters]
        for j in range(length - 2, -1, -1):
            inner = model.move + (emit[:, j + 1] + backward[:, j + 1])[:, None, :]
            backward[:, j] = np.where(real[:, j + 1, None], logsumexp(inner, 2), backward[:, j + 1])
            pair = np.exp(forward[:, j, :, None] + inner - total[:, None, None]) * real[:, j + 1, None, None]
            gradient[1] += pair.sum(0)
            np.add.at(gradient[1], (tags[:, j][real[:, j + 1]], tags[:, j + 1][real[:, j + 1]]), -1)
        single = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        single[rows[:, None], np.arange(length), tags] -= real
        for tag in range(3):
            gradient[1][tag] += single[before == tag, 0].sum(0)
        gradient[2] += single[before == FIRST, 0].sum(0)
        flat = index.reshape(-1)
        for state in range(3):
            gradient[0][:, state] = np.bincount(flat, np.repeat(single[:, :, state].reshape(-1), width), HASHED)
        for k, p in enumerate(parameters):
            g = (gradient[k] / n + penalty * np.where(p == FORBIDDEN, 0, p)) * free[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


Window = tuple[Sequence[Sequence[int]], Sequence[int], int]  # features, tags, tag before


def features_of(tokens: list[str], a: int, b: int, file: list[int], alone: bool = False) -> list[list[int]]:
    """Features of the tokens from a to b within their text; ``alone``: without the tokens around."""
    shapes = [shape(t) for t in tokens[a:b]]
    if alone:
        return [s + file for s in shapes]
    n = len(tokens)
    codes = [code(t) for t in [EDGE["^"]] * max(0, 3 - a) + tokens[max(0, a - 3):b + 2] + [EDGE["$"]] * max(0, b + 2 - n)]
    return [s + neighbours(*codes[k:k + 3], *codes[k + 4:k + 6]) + file for k, s in enumerate(shapes)]


def tags_of(found: list[re.Match], values: list[tuple[int, int]]) -> list[int]:
    tags, last, k = [], None, 0
    for m in found:
        while k < len(values) and values[k][1] <= m.start():
            k += 1
        hit = k if k < len(values) and values[k][0] < m.end() and m.end() - len(m[0].lstrip()) < values[k][1] else None
        tags.append(2 if hit is None else 1 if hit == last else 0)
        last = hit
    return tags


def examples(text: str, kinds: Sequence[str] = ()) -> Iterator[Window]:
    """Windows of a text as it is, with the tags its pattern spans give, and one with something planted."""
    found = list(TOKEN.finditer(text))
    if not found:
        return
    values, tokens, n = pattern_spans(text)[1], [m[0] for m in found], len(found)
    tags = tags_of(found, values)
    chosen = np.zeros(n, bool)
    for at in range(n):
        if tags[at] != 2 or ALIKE.fullmatch(tokens[at].strip()):
            chosen[max(0, at - NEAR):at + NEAR + 1] = True
    file, digest = number(file_features(text)), zlib.crc32(text.encode("utf-8", "replace"))
    windows = [(a, b, True) for a, b in np.flatnonzero(np.diff(np.concatenate([[False], chosen, [False]]))).reshape(-1, 2).tolist()]
    if digest % ONE_IN == 0:
        at = digest // ONE_IN % n
        windows.append((at, min(n, at + LENGTH), False))
    for a, b, twice in windows:
        before = tags[a - 1] if a else FIRST
        yield features_of(tokens, a, b, file), tags[a:b], before
        if twice:
            yield features_of(tokens, a, b, file, alone=True), tags[a:b], before
    if kinds and has_planted(text):
        rng = random.Random(digest)
        yield planted(text, found, rng, rng.choice(kinds), file)
        yield planted(text, found, rng, None, file)


# One document in so many gets a secret and something harmless planted: its last two windows.
PLANT_IN = 3


def has_planted(text: str) -> bool:
    return zlib.crc32(text.encode("utf-8", "replace")) % PLANT_IN == 1


ALPHABET = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "sign": "!@#$%^&*?+~-_"}
MIXED = ALPHABET["lower"] + ALPHABET["upper"] + ALPHABET["digit"]
ANNOUNCED = ("password is", "the password is", "passphrase is", "the passphrase is", "passphrase:", "passwd:", "pwd =", "pwd:", "pass:",
             "api key:", "api key is", "key =", "access key", "access key:", "private key:", "secret is", "secret key:", "auth:",
             "authorization:", "bearer", "token is", "credentials:", "client secret:", "login with", "signing key =", "my key is")
BESIDE = ("see", "file", "order", "number", "version", "id", "at", "call", "from", "page", "ref", "commit", "by", "mail")


def drawn(rng: random.Random, letters: str, least: int, most: int) -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))


def made_prefixed(rng: random.Random) -> str:
    """A service's token: a short name, maybe a second one, and random letters and digits."""
    parts = [drawn(rng, rng.choice([ALPHABET["lower"], ALPHABET["upper"]]), 2, 5) for _ in range(rng.randint(1, 2))]
    return rng.choice("__-.").join([*parts, drawn(rng, MIXED, 16, 44)])


def made_signed(rng: random.Random) -> str:
    """A password of letters, digits and signs."""
    middle = [rng.choice(ALPHABET["sign"]) for _ in range(rng.randint(1, 3))] + [rng.choice(ALPHABET["digit"]) for _ in range(rng.randint(0, 3))]
    body = [*drawn(rng, ALPHABET["lower"] + ALPHABET["upper"], 5, 11), *middle]
    rng.shuffle(body)
    return rng.choice(ALPHABET["lower"]) + "".join(body) + rng.choice(MIXED)


def made_base64(rng: random.Random) -> str:
    return drawn(rng, MIXED + "+/", 20, 64) + rng.choice(["", "=", "=="])


def made_grouped(rng: random.Random) -> str:
    """Groups of random letters and digits between signs."""
    letters = rng.choice([ALPHABET["upper"] + ALPHABET["digit"], MIXED, MIXED])
    least = rng.choice([2, 4])
    return rng.choice(":;=,:").join(drawn(rng, letters, least, least + 4) for _ in range(rng.randint(3, 8)))


KINDS_MADE = ("prefixed", "signed", "base64", "grouped")
ALONE_TOO = ("prefixed", "base64")  # their shape tells


def harmless(rng: random.Random, words: Sequence[str]) -> str:
    """Something that is no secret, though long or full of digits or signs."""
    word, other = (rng.choice(words).strip(".,;:!?\"'").lower() or "a" for _ in range(2))
    number = str(rng.randrange(10**rng.randint(3, 12)))
    return rng.choice([
        f"https://www.{word}.com/{other}/{number}.html", f"http://{word}-{other}.org/?id={number}&x={word}", f"{word}.{other}@{word}.net",
        f"{word}_{other}_{number}.jpg", f"/usr/{word}/{other}-{number}.log", f"v{rng.randrange(9)}.{rng.randrange(30)}.{number[:2]}-{word}",
        f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}T1{rng.randrange(9)}:30:00", f"+{number[:2]} {number} {number[:4]}",
        number, f"#{number}", f"{word.title()}{other.title()}{word.title()}", f"{word.upper()}-{number}", f"{word}{number}", word + other + word,
        f"{word}!!", f"{word}***", f"[{other}]({word})", f"{word}|{other}", f"{number}%", f"${number}.00"])


def planted(text: str, found: list[re.Match], rng: random.Random, kind: str | None, file: list[int]) -> Window:
    """A window about something put between two tokens of a text: a made-up secret of a kind, or what is none."""
    words = [m[0].strip() for m in found[:400]]
    at = rng.choice(found).start()
    quote = rng.choice(["", "", "", '"', "'"])
    intro = rng.choice(ANNOUNCED)
    if kind is None:
        what = harmless(rng, words) if rng.random() < 0.6 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
        intro = intro if rng.random() < 0.4 and not any(c.isdigit() for c in what) else rng.choice(BESIDE)
        quote = rng.choice(["", "", '"'])
    else:
        what = globals()[f"made_{kind}"](rng)
    bare = kind in (None, *ALONE_TOO) and rng.random() < 0.4
    left = text[max(0, at - 150):at] + " " + ("" if bare else intro + " ") + quote
    whole = left + what + quote + rng.choice(["", "", ".", ","]) + " " + text[at:at + 100].lstrip()
    tokens = list(TOKEN.finditer(whole))
    tags = tags_of(tokens, [] if kind is None else [(len(left), len(left) + len(what))])
    inside = [i for i, m in enumerate(tokens) if m.end() > len(left) and m.start() < len(left) + len(what)]
    a, b = max(0, inside[0] - 5), min(len(tokens), inside[-1] + 4)
    return features_of([m[0] for m in tokens], a, b, file, alone=bare and rng.random() < 0.5), tags[a:b], 2 if a else FIRST


def spared(model: ChainModel, windows: list[Window], share: float = 0.0005) -> float:
    """The margin with which at most a share of the harmless windows as they are has a span of the field."""
    need = []
    for features, tags, before in windows:
        if all(t == 2 for t in tags):
            scores = np.stack([model.emit[f].sum(0) for f in features])
            start = model.start if before == FIRST else model.move[before]
            best, plain, gain = scores[0] + start, scores[0][2] + start[2], scores[0][0] + start[0]
            for row in scores[1:]:
                best = (best[:, None] + model.move).max(0) + row
                plain = plain + model.move[2, 2] + row[2]
            need.append(float(max(best.max(), gain) - plain))
    need.sort(reverse=True)
    return max(0.0, need[min(len(need) - 1, int(share * len(need)))] + 0.01) if need else 0.0


def crf_spans(text: str, model: ChainModel | Tagger) -> list[tuple[int, int]]:
    return (model if isinstance(model, Tagger) else Tagger(model)).spans(text)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def all_spans(text: str | None, model: ChainModel | Tagger) -> tuple[list[Span], list[Span]]:
    """Spans of the patterns, and these with the field's."""
    if not text:
        return [], []
    base, _ = pattern_spans(text)
    more = [(a, 3, b) for a, b in crf_spans(text, model) if not any(s < b and a < e for s, _, e in base)]
    return base, sorted(base + more)


def fit_windows(windows: list[Window], real: list[bool], **options) -> ChainModel:
    """The field of some windows, its margin from those that are ``real``: with nothing planted."""
    model = fit_chain(windows, **options)
    model.margin = spared(model, [w for w, r in zip(windows, real, strict=True) if r])
    return model


def fit(docs: DataFrame, sampled: int = 8000, kinds: Sequence[str] = KINDS_MADE) -> ChainModel:
    import pyarrow as pa
    ids = (docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sampled))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                if not isinstance(text, str):
                    continue
                found = list(examples(text, kinds))
                plain = len(found) - 2 * (bool(kinds) and has_planted(text))
                if found:
                    yield pd.DataFrame({"doc_id": doc_id, "at": range(len(found)), "before": [b for _, _, b in found],
                                        "real": [k < plain for k in range(len(found))], "tags": [t for _, t, _ in found],
                                        "features": [[x for f in fs for x in f] for fs, _, _ in found]})

    # the chosen ids are at most ``sampled`` rows, and of several texts under one id the smallest is used
    texts = (docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), "doc_id")
             .groupBy("doc_id").agg(F.min("text").alias("text")))
    found = texts.mapInPandas(rows, "doc_id long, at int, before int, real boolean, tags array<int>, features array<int>").toArrow()
    # kept as arrays: the driver would hold an object for each number of a list
    found = found.sort_by([("doc_id", "ascending"), ("at", "ascending")])
    chosen, tags, flat = [], None, None
    for before, tags, flat in zip(*(found[c] for c in ("before", "tags", "features")), strict=True):
        tags = tags.values.to_numpy()
        chosen.append((flat.values.to_numpy().reshape(len(tags), -1), tags, before.as_py()))
    model = fit_windows(chosen, found["real"].to_pylist())
    del found, chosen, tags, flat
    pa.default_memory_pool().release_unused()  # else the driver keeps it for later steps
    return model


def scan(docs: DataFrame, model: ChainModel) -> DataFrame:
    """Counts and spans of every document."""
    def rows(batches):
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"]
        tagger = Tagger(model)
        for part in parts(batches):
            out = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                base, spans = all_spans(text, tagger)
                kinds = Counter(kind for _, kind, _ in spans)
                out.append((doc_id, kinds[0], kinds[1], kinds[2], hashlib.sha256(joined(base).encode()).hexdigest(),
                            joined(spans), kinds[3]))
            yield arrow(pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"}), SPANS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, SPANS)


def redact(docs: DataFrame, model: ChainModel, mark: str = "[secret]") -> DataFrame:
    """The documents, all columns kept, with every span replaced by ``mark``."""
    def one(text: str | None, tagger: Tagger) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for start, _, end in all_spans(text, tagger)[1]:
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def rows(batches):
        import pyarrow as pa
        tagger = Tagger(model)
        for part in parts(batches):
            place = part.schema.get_field_index("text")
            texts = pa.array([one(t, tagger) for t in part.column(place).to_pylist()], part.schema.field(place).type)
            yield part.set_column(place, part.schema.field(place), texts)

    return docs.mapInArrow(rows, docs.schema)
