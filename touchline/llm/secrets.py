"""Secret scanning: base rules, and a linear-chain conditional random field that adds spans.

Tokens are runs of the characters that secrets are made of, and runs of other characters that are
not white space.  Tags are outside, begin and inside.  Features are the shape of a token, the
words beside it, and what the whole file is like.  Begin is only possible for tokens long and mixed
enough (``possible``) and for tokens of any length after an assignment mark or, unless they are plain words, a hint word
(``hinted``), and inside only for a token that touches the one before it.  Chains are cut from white space
to white space with all words that a possible token's features or tags depend on; outside the chains all
tags are outside.  Viterbi decoding is exact over the whole of a run, however long it is, and texts without
a possible token cost one scan.

There are no labelled secrets.  Positive examples are the tokens that base rules mark and, since those have
few shapes, made ones: values drawn from several alphabets, lengths and part counts, put into the sampled
texts behind a hint word or alone (``made_secret``).  Negative ones are the other tokens of the texts and
made ones of the texts' own words: addresses, paths, dates, numbers, names (``made_plain``).  Hint words are
features only as a class, so what follows one of them tells about all.  The field is fitted to base and made
examples first; chains without a label in which it finds nothing are negative examples of a second fit, the others
may hold secrets and teach nothing.
The words beside a token are dropped from half of all examples, so the shape alone can tell.
"""

from __future__ import annotations

import math
import random
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import input_table, joined_ranges, slices, table

KINDS = ("assign", "access", "hex", "model")
OUT, BEGIN, INSIDE = 0, 1, 2
FEATURES = 1 << 14
#: About so many texts at most train the field, half of them with a long run if there are enough, and of each so many
#: chains of its own (the first ones); longer chains are cut into pieces of so many tokens.
SAMPLE, PER_TEXT, LONGEST = 4_000, 2, 16
#: Made examples of each sort in a sampled text: so many, and more, up to MOST_MADE, where the table has fewer texts than SAMPLE.
MADE, MOST_MADE = 2, 16
LEAST_TOKEN = 12
BESIDE = 2
#: Tokens that are decoded at a time (one chain at least).
LOT_TOKENS = 1 << 15
# Base rules: patterns and least lengths.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# What made examples draw from: names of secrets, what is between name and value, and the values' alphabets.
NAMES = ("secret", "token", "password", "credential", "login", "private", "access")
BETWEEN = (" ", " ", ": ", ": ", " = ", "=", ":", " is ", ' = "', " := ")
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (DIGITS + LOWER[:6], DIGITS + LOWER[:6].upper(), DIGITS + LOWER, DIGITS + LOWER.upper(),
             DIGITS + LOWER + LOWER.upper(), DIGITS + LOWER + LOWER.upper(), DIGITS + LOWER + LOWER.upper() + "+/", LOWER + LOWER.upper())
PLAIN = re.compile(r"[^\w\s:=]*[^\W\d_]+[^\w\s:=]*")
LETTERS = re.compile(r"[^\W\d_]{2,12}")
# Words that often stand beside a secret.
HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "cred", "bearer", "private", "access", "login", "sign")
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
#: What makes the tokens beside it possible: a hint word, or an assignment mark.
SPOT = re.compile(rf"(?ai:{'|'.join(HINTS)})|[:=]")
#: White-space words from a spot: before it the context, after it those that a hint reaches and their context.
WORDS_BEFORE, WORDS_AFTER = BESIDE, 2 * BESIDE
WORD_END, NEXT_WORDS = re.compile(r"\S*"), re.compile(rf"(?:\s+\S+){{0,{WORDS_AFTER}}}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+|[^\sA-Za-z0-9+/_.=-]+")


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base rules' matches, by start and then kind.  runs: of RUN in the text."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    # Both other kinds are made of a run's characters and longer than the shortest run.
    for a, z in runs:
        part = text[a:z]
        if "AKIA" in part:
            out += [("access", a + m.start(), a + m.end()) for m in ACCESS.finditer(part) if len(m[0]) >= LEAST["access"]]
        if z - a >= LEAST["hex"]:
            out += [("hex", a + m.start(), a + m.end()) for m in HEX.finditer(part) if len(m[0]) >= LEAST["hex"]]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def possible(token: str) -> bool:
    """Whether a token may begin a secret: long, with a letter and a digit or both cases mixed within."""
    body = token.strip("=.-_/+")
    if len(body) < LEAST_TOKEN or not any(c.isalpha() for c in body):
        return False
    digits = sum(c.isdigit() for c in body)
    return digits > 0 or (body[1:].lower() != body[1:] and body.upper() != body and len(body) >= 16)


def hinted(tokens: list[tuple[str, int, int]], i: int) -> bool:
    """Whether an assignment mark ends the token before, or a hint word and a mark are in the token, or a hint word is before it.

    Only marks may be between; after a hint word alone, plain words ("keys here") can't begin a secret.
    """
    word = tokens[i][0]
    if not any(c.isalnum() for c in word):
        return False
    if i:
        before = tokens[i - 1][0]
        if before[-1] in ":=":
            return True
        body = word.strip("=.-_/+")
        if not (body.isalpha() and body[1:] in (body[1:].lower(), body[1:].upper())):
            if _names(before) or i > 1 and not any(c.isalnum() for c in before) and _names(tokens[i - 2][0]):
                return True
    return "=" in word.rstrip("=") and _has_hint(word)


def _names(word: str) -> bool:
    """Whether a hint word names what follows; one with a value of its own doesn't."""
    return _has_hint(word) and "=" not in word.rstrip("=")


@lru_cache(1 << 16)
def _has_hint(word: str) -> bool:
    return any(h in word.lower() for h in HINTS)


@lru_cache(1 << 17)
def _slot(feature: str) -> int:
    from xxhash import xxh32_intdigest

    return xxh32_intdigest(feature) % FEATURES


def entropy(token: str) -> float:
    counts = [token.count(c) for c in set(token)]
    return -sum(n / len(token) * math.log2(n / len(token)) for n in counts)


def _class(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m"


def shape_features(token: str) -> list[str]:
    n, classes = len(token), "".join(map(_class, token))
    digits, upper, lower, marks = (classes.count(c) for c in "dulm")
    turns = sum(a != b for a, b in zip(classes, classes[1:]))
    longest = max(map(len, re.findall(r"l+|ul+|u+", classes)), default=0)
    vowels = sum(token.count(c) for c in "aeiouAEIOU")
    kinds = "".join(c for c in "dulm" if c in classes)
    bits = entropy(token)
    return [f"n{min(n, 64).bit_length()}", f"n8{min(n, 80) // 8}", f"d{10 * digits // n}", f"u{10 * upper // n}", f"l{10 * lower // n}", f"m{min(marks, 6)}",
            f"t{10 * turns // n}", f"e{int(2 * bits)}", f"q{int(10 * bits / math.log2(n)) if n > 1 else 0}", f"k{kinds}", f"r{min(longest, 12)}", f"s{10 * longest // n}",
            f"v{10 * vowels // max(1, upper + lower)}", f"x{int(all(c in '0123456789abcdefABCDEF' for c in token))}", f"kt{kinds}{5 * turns // n}",
            f"a{'.' in token}{'/' in token}{'=' in token[:-2]}"]


def word_features(word: str, place: str) -> list[str]:
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "0", word)))[:6]
    return [f"{place}s{shape}", f"{place}h{_has_hint(word)}"]


def beside_features(tokens: list[tuple[str, int, int]], i: int, shape: list[str]) -> list[str]:
    """Whether a hint word or an assignment mark is before the token, alone and along with parts of its shape."""
    before = [tokens[k][0] for k in range(max(0, i - BESIDE), i)]
    kind = f"b{any(map(_has_hint, before))}{bool(before) and before[-1][-1] in ':='}"
    return [kind, *(kind + x for x in shape if x[0] in "ktnr")]


def file_features(text: str, n_runs: int, part: int = 1 << 20) -> list[str]:
    """Of the whole text, read in parts; a hint may go over a part's end."""
    marks, found, longest = 0, set(), max(map(len, HINTS[:6]))
    for at in range(0, len(text) if n_runs else 0, part):
        low = text[at : at + part + longest - 1].lower()
        marks += sum(text.count(c, at, at + part) for c in "={};")
        found |= {h for h in HINTS[:6] if h not in found and h in low}
    density = marks / max(1, len(text))
    return [f"fr{min(n_runs, 15).bit_length()}", f"fc{min(9, int(density * 200))}", f"fh{len(found)}", f"fl{len(text).bit_length() // 2}"]


class Chain:
    """A window of tokens: their spans, features, and which tags each may have."""

    def __init__(self, tokens: list[tuple[str, int, int]], file: list[str], drop_words: bool = False):
        self.spans = [(a, z) for _, a, z in tokens]
        self.features, self.allowed = [], []
        for i, (word, a, z) in enumerate(tokens):
            # A token that can only be outside needs no features.
            own = []
            may = possible(word) or hinted(tokens, i)
            touches = i > 0 and tokens[i - 1][2] == a
            if may or touches:
                shape = shape_features(word)
                own = ["bias", *file, *shape]
                own.append(f"touch{touches}")
                if not drop_words:
                    own += beside_features(tokens, i, shape)
                    for k in range(1, BESIDE + 1):
                        own += word_features(tokens[i - k][0], f"-{k}") if i >= k else [f"-{k}none"]
                        own += word_features(tokens[i + k][0], f"+{k}") if i + k < len(tokens) else [f"+{k}none"]
            self.features.append([_slot(x) for x in own])
            self.allowed.append((True, may, touches))

    def cut(self, first: int, end: int) -> None:
        self.spans, self.features, self.allowed = (x[first:end] for x in (self.spans, self.features, self.allowed))


def windows_of(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint (start, end), from white space to white space, that hold all possible tokens with their context."""
    spots = [(a, z) for a, z in runs if possible(text[a:z])] + [m.span() for m in SPOT.finditer(text)]
    out: list[tuple[int, int]] = []
    word_end, high = -1, 0
    for a, z in sorted(spots):
        done, low = high, a
        for k in range(WORDS_BEFORE + 1):
            while k and low > done and text[low - 1].isspace():
                low -= 1
            while low > done and not text[low - 1].isspace():
                low -= 1
        # Spots of one word end alike: long words are read once.
        if z > word_end:
            word_end = WORD_END.match(text, z).end()
            high = max(high, NEXT_WORDS.match(text, word_end).end())
        if out and low <= done:
            out[-1] = out[-1][0], high
        else:
            out.append((low, high))
    return out


def chains(text: str, runs: list[tuple[int, int]], drop_words: bool = False, file: list[str] | None = None) -> list[Chain]:
    """One for each window with a possible token.  file: the features of the whole file, if the text is a part of one."""
    windows, out = windows_of(text, runs), []
    if windows and file is None:
        file = file_features(text, max(1, sum(possible(text[a:z]) for a, z in runs)))
    for low, high in windows:
        c = Chain([(m[0], *m.span()) for m in TOKEN.finditer(text, low, high)], file, drop_words)
        begins = [i for i, (_, begin, _) in enumerate(c.allowed) if begin]
        if begins:
            last = begins[-1]
            while last + 1 < len(c.allowed) and c.allowed[last + 1][INSIDE]:
                last += 1
            # One token before the first possible one, and one after all that touch the last.
            c.cut(max(0, begins[0] - 1), last + 2)
            out.append(c)
    return out


def gold(chain: Chain, spans: list[tuple[str, int, int]]) -> list[int]:
    """Tags by the base spans: the token that holds a span's end begins it, touching ones before are part of the context."""
    tags = [OUT] * len(chain.spans)
    for i, (a, z) in enumerate(chain.spans):
        if chain.allowed[i][BEGIN] and any(s < z and e > a and e <= z for _, s, e in spans):
            tags[i] = BEGIN
        elif chain.allowed[i][INSIDE] and i and tags[i - 1] != OUT and any(s < a and e >= z for _, s, e in spans):
            tags[i] = INSIDE
    return tags


class Field:
    """The conditional random field: weights[feature, tag] and moves[tag, tag]."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @staticmethod
    def lots(chains_: list[Chain]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries (place, feature), allowed[chain, place, tag] and lengths, all chains padded to the longest."""
        longest = max(len(c.spans) for c in chains_)
        n = np.array([len(c.spans) for c in chains_])
        allowed = np.zeros((len(chains_), longest, 3), dtype=bool)
        allowed[:, :, OUT] = True
        place, size, feature = [], [], array("q")
        for k, c in enumerate(chains_):
            allowed[k, : len(c.spans)] = c.allowed
            for i, f in enumerate(c.features):
                place.append(k * longest + i)
                size.append(len(f))
                feature.extend(f)
        return np.repeat(place, size), np.frombuffer(feature, dtype=np.int64), allowed, n, np.arange(longest) < n[:, None]

    def scores(self, place: np.ndarray, feature: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        size = allowed.shape[0] * allowed.shape[1]
        out = np.stack([np.bincount(place, self.weights[feature, t], minlength=size) for t in range(3)], axis=1).reshape(allowed.shape)
        return np.where(allowed, out, -1e9)

    @classmethod
    def fit(cls, place: np.ndarray, feature: np.ndarray, allowed: np.ndarray, tags: np.ndarray, n: np.ndarray,
            start: Field | None = None, steps: int = 120, rate: float = 0.1, l2: float = 1e-4) -> Field:
        """Maximum likelihood with forward-backward sums over all chains at once, by Adam.

        Cells are all chains' first tokens, then all second ones, and so on, longest chain first, so that each
        step over the chains works on whole blocks without padding.  Entries (place, feature); allowed[cell, tag],
        tags[cell], n[chain] (descending).
        """
        at = [int((n > i).sum()) for i in range(int(n[0]))]
        begin = np.concatenate([[0], np.cumsum(at)])
        chain = np.concatenate([np.arange(m) for m in at])
        later = np.arange(begin[1], begin[-1])
        earlier = np.concatenate([np.arange(begin[i], begin[i] + m) for i, m in enumerate(at[1:])] or [later])
        last = begin[n - 1] + np.arange(len(n))
        target, cells = np.eye(3)[tags], len(chain)
        pairs = target[earlier].T @ target[later]
        params = np.zeros(FEATURES * 3 + 9) if start is None else np.concatenate([start.weights.ravel(), start.moves.ravel()])
        mean, square = np.zeros_like(params), np.zeros_like(params)
        for step in range(1, steps + 1):
            weights, moves = params[:-9].reshape(FEATURES, 3), params[-9:].reshape(3, 3)
            emit = np.where(allowed, np.stack([np.bincount(place, weights[feature, t], minlength=cells) for t in range(3)], axis=1), -1e9)
            forward, backward = emit.copy(), np.zeros_like(emit)
            for i, m in enumerate(at[1:], 1):
                forward[begin[i] : begin[i + 1]] += _log_sum(forward[begin[i - 1] : begin[i - 1] + m, :, None] + moves, 1)
            total = _log_sum(forward[last], 1)
            for i in range(len(at) - 1, 0, -1):
                after = emit[begin[i] : begin[i + 1]] + backward[begin[i] : begin[i + 1]]
                backward[begin[i - 1] : begin[i - 1] + at[i]] = _log_sum(moves + after[:, None, :], 2)
            chance = np.exp(np.minimum(forward + backward - total[chain, None], 0))
            move = np.exp(np.minimum(forward[earlier][:, :, None] + moves + (emit + backward)[later][:, None, :] - total[chain[later], None, None], 0)).sum(axis=0)
            error = (chance - target) / len(n)
            grad_w = np.stack([np.bincount(feature, error[place, t], minlength=FEATURES) for t in range(3)], axis=1)
            grad = np.concatenate([grad_w.ravel(), ((move - pairs) / len(n)).ravel()]) + l2 * params
            mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
            params = params - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        return cls(params[:-9].reshape(FEATURES, 3), params[-9:].reshape(3, 3))

    def decode(self, chains_: list[Chain]) -> list[list[int]]:
        """The best tags of each chain (Viterbi)."""
        if not chains_:
            return []
        place, feature, allowed, n, real = self.lots(chains_)
        rows = self.best(place, feature, allowed, real)
        return [r[:k].tolist() for r, k in zip(rows, n)]

    def best(self, place: np.ndarray, feature: np.ndarray, allowed: np.ndarray, real: np.ndarray) -> np.ndarray:
        """tags[chain, place] of chains as lots() gives them."""
        emit = self.scores(place, feature, allowed)
        best, back = emit[:, 0], []
        for i in range(1, emit.shape[1]):
            over = best[:, :, None] + self.moves
            came = over.argmax(axis=1)
            new = over.max(axis=1) + emit[:, i]
            back.append(np.where(real[:, i, None], came, np.arange(3)))
            best = np.where(real[:, i, None], new, best)
        tag = best.argmax(axis=1)
        tags = [tag]
        for came in reversed(back):
            tag = came[np.arange(len(tag)), tag]
            tags.append(tag)
        return np.stack(tags[::-1], axis=1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def model_spans(chain: Chain, tags: list[int]) -> list[tuple[int, int]]:
    """Spans of begin and the insides after it; what only frames a token at its ends is cut off."""
    out = []
    for i, t in enumerate(tags):
        if t == BEGIN:
            out.append(list(chain.spans[i]))
        elif t == INSIDE and out and i and tags[i - 1] != OUT:
            out[-1][1] = chain.spans[i][1]
    return [tuple(x) for x in out]


def made_value(r: random.Random, alone: bool) -> str:
    """A random value: of one part or several, some with a short prefix; longer ones where no name tells."""
    chars = r.choice(ALPHABETS)
    size = int(round((16 if alone else 8) * 2 ** r.uniform(0, 2 if alone else 3)))
    if not alone and r.random() < 0.15:
        chars, size = DIGITS, max(10, size)
    value = "".join(r.choices(chars, k=size))
    if r.random() < 0.3:
        mark = r.choice("-_.")
        for _ in range(r.randint(1, 3)):
            value += mark + "".join(r.choices(chars, k=r.randint(6, 32)))
    if r.random() < 0.3:
        value = "".join(r.choices(LOWER, k=r.randint(2, 5))) + r.choice("-_") + value
    return value


def made_secret(r: random.Random, words: list[str]) -> tuple[str, str]:
    """What leads to a made value (nothing, or a name and what is between), and the value."""
    if r.random() < 0.4:
        return "", made_value(r, True)
    name = r.choice(NAMES)
    if r.random() < 0.4:
        name = r.choice(words) + r.choice("_-") + name
    name = r.choice((name, name, name.upper(), name.capitalize()))
    return name + r.choice(BETWEEN), made_value(r, False)


def made_plain(r: random.Random, words: list[str]) -> str:
    """Something of the text's own words that looks a little like a secret and isn't one."""
    w = lambda: r.choice(words)
    n = lambda digits: str(r.randrange(10**digits))
    low = w().lower()
    date = f"20{r.randrange(10, 30)}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d}"
    said = r.choice((w(), w().capitalize(), n(r.randint(1, 6)), f"{n(2)}.{n(2)}", date, f"{w()}_{w()}", f"{w()}-{n(2)}", "true"))
    name = r.choice((*NAMES, w(), w()))
    return r.choice((
        f"{name}{r.choice(BETWEEN)}{said}", f"{name}{r.choice(BETWEEN)}{said}", f"{name} {w()} {said}",
        f"https://www.{low}{w().lower()}.com/{w()}/{w()}-{n(3)}", f"/{w()}/{w()}/{w()}_{n(2)}.txt", f"{low}.{n(2)}@{w().lower()}.org",
        f"{w()}-{date}-{n(3)}", f"{date}T{n(1)}0:{n(1)}5:00", f"{low}{w().capitalize()}{w().capitalize()}", f"{w().upper()}_{w().upper()}_{n(2)}",
        f"{w()}-{n(1)}.{n(1)}.{n(2)}", f"+{n(2)}-{n(3)}-{n(7)}", f"{low}_{w()}_{w()}_{n(4)}", f"{low}-{w()}.{w()}.{low}{n(1)}"))


def made_chains(text: str, r: random.Random, n_runs: int, drop_words: bool, made: int = MADE) -> list[tuple[Chain, list[int]]]:
    """Chains with made secrets and made plain tokens among words of the text, and their tags.

    n_runs: possible runs of the text; the file features are those of the text with what is put in.
    """
    out = []
    for k in range(2 * made):
        at = r.randrange(len(text) + 1)
        # Plain words alone: other tokens of the text may be secrets that nobody has labelled.
        around = [w for w in text[max(0, at - 120) : at + 120].split()[1:-1] if PLAIN.fullmatch(w) and not possible(w)]
        words = LETTERS.findall(" ".join(around)) or ["name"]
        lead, value = made_secret(r, words) if k < made else ("", made_plain(r, words))
        place = r.randrange(len(around) + 1)
        head = " ".join([*around[:place], lead]) if around[:place] else lead
        head = head if lead or not head else head.rstrip() + " "
        small = head + value + " " + " ".join(around[place:])
        runs = [m.span() for m in RUN.finditer(small)]
        spans = base_spans(small, runs)
        if k < made:
            spans.append(("model", len(head), len(head) + len(value)))
        file = file_features(f"{text} {small}", max(1, n_runs + sum(possible(small[a:z]) for a, z in runs)))
        out += [(c, gold(c, spans)) for c in chains(small, runs, drop_words, file)]
    return out


def training_chains(docs: DataFrame, sample: int = SAMPLE) -> pa.Table:
    """h, k, features, sizes (features a token), allowed, tags, sure: the chains the field is fitted to, in a fixed order.

    sure: whether the chain has a label, that of a base span or of being made.
    """
    rows = input_table(docs, doc_id="long", text="string").select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    rows = rows.withColumn("long_run", F.col("text").rlike("[A-Za-z0-9+/_.=-]*[0-9][A-Za-z0-9+/_.=-]{11}|[A-Za-z0-9+/_.=-]{11}[0-9]"))
    n_long, n = rows.agg(F.count_if("long_run"), F.count(F.lit(1))).first()
    of_long = min(n_long, max(sample // 2, sample - (n - n_long)))
    share = F.when(F.col("long_run"), of_long / max(1, n_long)).otherwise((sample - of_long) / max(1, n - n_long))
    made = min(MOST_MADE, MADE * max(1, sample // max(1, n)))
    chosen = rows.filter(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                r, runs, drop = random.Random(h), [m.span() for m in RUN.finditer(text)], bool(h & 1)
                spans = base_spans(text, runs)
                n_runs = sum(possible(text[a:z]) for a, z in runs)
                every = [(c, gold(c, spans), False) for c in chains(text, runs, drop)[:PER_TEXT]]
                every += [(c, t, True) for c, t in made_chains(text, r, n_runs, drop, made)]
                pieces = [(c, t, known or any(t), at) for c, t, known in every for at in range(0, len(t), LONGEST)]
                for k, (c, tags, sure, at) in enumerate(pieces):
                    features = c.features[at : at + LONGEST]
                    out.append((h, k, [x for f in features for x in f], [len(f) for f in features],
                                [int(m) + 2 * int(t) for _, m, t in c.allowed[at : at + LONGEST]], tags[at : at + LONGEST], sure))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    names = ["h", "k", "features", "sizes", "allowed", "tags", "sure"]
    short, byte = pa.list_(pa.int16()), pa.list_(pa.int8())
    kinds = [pa.int64(), pa.int32(), short, short, byte, byte, pa.bool_()]
    found = chosen.mapInArrow(windows, "h long, k int, features array<short>, sizes array<short>, allowed array<byte>, tags array<byte>, sure boolean").toArrow()
    # Rows alike in doc_id and text give the same chains.
    return found.sort_by([("h", "ascending"), ("k", "ascending")]).combine_chunks()


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """A field fitted to chains of about ``sample`` texts at most (chosen by hash) and to examples made in them.

    What the driver holds are arrays, bounded by the sample and by the first ``PER_TEXT`` chains of a text.
    """
    found = training_chains(docs, sample)
    if not found.num_rows:
        return Field(np.zeros((FEATURES, 3)), np.zeros((3, 3)))
    flat = lambda name: np.asarray(found.column(name).combine_chunks().flatten())
    n = np.asarray(pc.list_value_length(found.column("tags"))).astype(np.int64)
    sizes, feature, tags = flat("sizes").astype(np.int64), flat("features"), flat("tags")
    allowed = np.stack([np.ones(len(tags), dtype=bool), flat("allowed") & 1 > 0, flat("allowed") & 2 > 0], axis=1)
    entries = np.cumsum(sizes) - sizes

    def fit(kept: np.ndarray, start: Field | None = None, steps: int = 120) -> Field:
        mine = np.flatnonzero(kept)[np.argsort(-n[kept], kind="stable")]
        first = (np.cumsum(n) - n)[mine]
        # Token i of all chains that have one, for each i.
        cells = np.concatenate([first[n[mine] > i] + i for i in range(int(n[mine].max()))])
        at = joined_ranges(entries[cells], sizes[cells])
        return Field.fit(np.repeat(np.arange(len(cells)), sizes[cells]), feature[at].astype(np.int64), allowed[cells], tags[cells].astype(np.int64), n[mine], start, steps)

    sure = np.asarray(found.column("sure").combine_chunks().to_numpy(zero_copy_only=False)).astype(bool)
    field = fit(sure) if sure.any() else fit(~sure)
    # Unlabelled chains that the field tags may hold secrets: they don't teach it that theirs is none.
    longest, chain = int(n.max()), np.repeat(np.arange(len(n)), n)
    cell = chain * longest + joined_ranges(np.zeros(len(n), np.int64), n)
    padded = np.zeros((len(n) * longest, 3), dtype=bool)
    padded[:, OUT] = True
    padded[cell] = allowed
    found_tags = field.best(np.repeat(cell, sizes), feature.astype(np.int64), padded.reshape(-1, longest, 3), np.arange(longest) < n[:, None])
    return fit(sure | (found_tags == OUT).all(axis=1), field, 60) if sure.any() else field


def secret_spans(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, base (array of kind, start, end) and added (the model's) for every document.

    Code points, end exclusive; base spans by start, then kind.  The model adds spans that don't
    touch a base span.  Null texts are empty; repeated rows and null doc_ids are scanned row by row.
    """
    field = train(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.moves))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(*shared.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, "text"):
            base, every = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                runs = [m.span() for m in RUN.finditer(text)]
                base.append(base_spans(text, runs))
                every += [(i, c) for c in chains(text, runs)]
            added = [[] for _ in base]
            # Chains of like length together, so that padding is small.
            every.sort(key=lambda x: len(x[1].spans))
            while every:
                # Padded to the longest, so many tokens at most, or one chain.
                most = max(1, LOT_TOKENS // len(every[-1][1].spans))
                lot, every = every[-most:], every[:-most]
                for (i, c), tags in zip(lot, model.decode([c for _, c in lot])):
                    added[i] += [("model", a, z) for a, z in model_spans(c, tags) if not any(s < z and e > a for _, s, e in base[i])]
            cells = lambda spans: pa.array([[{"kind": k, "start": a, "end": z} for k, a, z in x] for x in spans], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), cells(base), cells([sorted(x, key=lambda s: s[1]) for x in added])], names=["doc_id", "base", "added"])

    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    return input_table(docs, doc_id="long", text="string").mapInArrow(scan, f"doc_id long, base {span}, added {span}")


def op7_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of each document; null and empty texts have none."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    ordered = F.transform(F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))), lambda x: x)
    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(F.encode(joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"), joined(ordered).alias("spans"))
