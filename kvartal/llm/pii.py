"""Personal data: rules, and a character-level bidirectional LSTM with a CRF on top.

The rules find four kinds of spans. The model, trained in numpy on labelled spans set into
snippets of the documents themselves, half of them in forms that the rules miss (phones without
a plus, dotted cards, letters beyond ASCII, numbers beside other digits), reads overlapping
windows of the whole text and tags every character; where windows overlap, the one that sees more on both sides of a character
decides, so a span that crosses windows comes out whole. Spans of the model are added where
they overlap none of the rules' and hold what their kind must hold (checksum, ranges, counts).

Every span holds a digit or an @, so a window without either could add none and is not read.

Defined results: a null or empty text has no spans; without any text to take snippets from,
only the rules work; repeated rows get the same spans; columns of other names stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
#: B and I of every kind, after O
TAGS = 1 + 2 * len(KINDS)
WINDOW, STRIDE = 96, 48
#: snippets of documents that spans are set into for training, at most
SNIPPETS = 1500
HIDDEN = 20
#: ASCII characters (any digit as 0, any letter as a or A), all others, and the room beyond a text
OTHER, BEYOND, ALPHABET = 128, 129, 130
_CODES = np.arange(OTHER + 1, dtype=np.uint8)
for _first, _last in ("09", "az", "AZ"):
    _CODES[ord(_first) : ord(_last) + 1] = ord(_first)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EMAIL_SHAPE = re.compile(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)+")
_IP_SHAPE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_PHONE_SHAPE = re.compile(r"[+(0-9][0-9 ().-]*[0-9]")
_SIGNS = re.compile("[0-9@]")

Span = tuple[str, int, int]


# ---------------------------------------------------------------- rules


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ so that long words cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def rule_spans(text: str) -> list[Span]:
    """Spans of the rules, by kind and start."""
    found = [("email", *span) for span in _emails(text)]
    for kind, pattern, holds in (
        ("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone),
    ):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m[0])]
    return found


def _sound(kind: str, text: str) -> bool:
    """Whether a span of the model holds what its kind must hold."""
    if kind == "email":
        return _EMAIL_SHAPE.fullmatch(text) is not None
    if kind == "ip":
        return _IP_SHAPE.fullmatch(text) is not None and _is_ip(text)
    if kind == "card":
        return _is_card(text) and not re.search(r"[^0-9 .-]", text)
    return _PHONE_SHAPE.fullmatch(text) is not None and _is_phone(text)


# ---------------------------------------------------------------- model


@dataclass
class Tagger:
    """Weights: for each direction input, recurrence and bias; emissions; CRF transitions."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator, hidden: int = HIDDEN) -> Tagger:
        scale = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
        weights = {"out": scale(2 * hidden, TAGS), "out_bias": np.zeros(TAGS, np.float32),
                   "step": np.zeros((TAGS, TAGS), np.float32)}
        for way in ("on", "back"):
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            weights |= {f"{way}_in": scale(ALPHABET, 4 * hidden),
                        f"{way}_again": scale(hidden, 4 * hidden), f"{way}_bias": bias}
        return cls(weights)

    def _run(self, way: str, codes: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction for codes (time, row), in reading order."""
        w_in = self.weights[f"{way}_in"] + self.weights[f"{way}_bias"]
        again = self.weights[f"{way}_again"]
        size = len(again)
        h = np.zeros((codes.shape[1], size), np.float32)
        c = np.zeros_like(h)
        states, kept = np.empty((*codes.shape, size), np.float32), []
        for t in range(len(codes)):
            z = w_in[codes[t]] + h @ again
            gates = 0.5 * np.tanh(0.5 * z[:, : 3 * size]) + 0.5
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            g = np.tanh(z[:, 3 * size :])
            before, c = c, f * c + i * g
            bent = np.tanh(c)
            if keep:
                kept.append((i, f, o, g, before, bent, h))
            h = o * bent
            states[t] = h
        return states, kept

    def emissions(self, codes: np.ndarray, keep: bool = False):
        on, kept_on = self._run("on", codes, keep)
        back, kept_back = self._run("back", codes[::-1], keep)
        both = np.concatenate([on, back[::-1]], axis=2)
        scores = both @ self.weights["out"] + self.weights["out_bias"]
        return (scores, both, kept_on, kept_back) if keep else scores

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tags (time, row) under emissions and transitions."""
        scores, step = self.emissions(codes), self.weights["step"]
        best, came = scores[0], []
        for t in range(1, len(scores)):
            ways = best[:, :, None] + step[None]
            came.append(ways.argmax(axis=1))
            best = ways.max(axis=1) + scores[t]
        tags = np.empty(codes.shape, np.int64)
        tags[-1] = best.argmax(axis=1)
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = came[t - 1][np.arange(codes.shape[1]), tags[t]]
        return tags

    # -------------------------------------------------------- training

    def _crf_slopes(self, scores: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of the negative log likelihood by emissions and by transitions."""
        step, (steps, rows, _) = self.weights["step"], scores.shape
        total = lambda x, axis: np.log(np.exp(x - (m := x.max(axis, keepdims=True))).sum(axis)) + m.squeeze(axis)
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = total(ahead[t - 1][:, :, None] + step, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = total(step[None] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        whole = total(ahead[-1], 1)[None, :, None]
        by_emission = np.exp(ahead + behind - whole)
        by_step = np.zeros_like(step)
        for t in range(1, steps):
            by_step += np.exp(
                ahead[t - 1][:, :, None] + step + (scores[t] + behind[t])[:, None, :] - whole[0][:, :, None]
            ).sum(0)
        np.subtract.at(by_step, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        by_emission[np.arange(steps)[:, None], np.arange(rows), tags] -= 1
        return by_emission / rows, by_step / rows

    def _back_through(self, way: str, codes: np.ndarray, kept: list, by_state: np.ndarray) -> dict:
        again = self.weights[f"{way}_again"]
        size = len(again)
        by_in = np.zeros_like(self.weights[f"{way}_in"])
        one_hot = np.eye(ALPHABET, dtype=np.float32)
        by_again, by_bias = np.zeros_like(again), np.zeros(4 * size, np.float32)
        dh, dc = np.zeros_like(by_state[0]), np.zeros_like(by_state[0])
        for t in range(len(codes) - 1, -1, -1):
            i, f, o, g, before, bent, h = kept[t]
            dh = dh + by_state[t]
            dc = dc + dh * o * (1 - bent * bent)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f),
                                 dh * bent * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            by_in += one_hot[codes[t]].T @ dz
            by_again += h.T @ dz
            by_bias += dz.sum(0)
            dh, dc = dz @ again.T, dc * f
        return {f"{way}_in": by_in, f"{way}_again": by_again, f"{way}_bias": by_bias}

    def slopes(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        scores, both, kept_on, kept_back = self.emissions(codes, keep=True)
        by_score, by_step = self._crf_slopes(scores, tags)
        by_state = by_score @ self.weights["out"].T
        half = by_state.shape[2] // 2
        return {
            "out": np.tensordot(both, by_score, ((0, 1), (0, 1))),
            "out_bias": by_score.sum((0, 1)),
            "step": by_step,
            **self._back_through("on", codes, kept_on, by_state[:, :, :half]),
            **self._back_through("back", codes[::-1], kept_back, by_state[::-1, :, half:]),
        }

    def fit(
        self, codes: np.ndarray, tags: np.ndarray, rng: np.random.Generator,
        epochs: int = 10, batch: int = 64, rate: float = 0.04,
    ) -> Tagger:
        """Adam over shuffled batches; codes and tags are (row, time)."""
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        n, all_steps = 0, epochs * -(-len(codes) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), batch):
                own, n = order[at : at + batch], n + 1
                for k, slope in self.slopes(codes[own].T, tags[own].T).items():
                    slope = np.clip(slope, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.99 * second[k] + 0.01 * slope * slope
                    pace = rate * (1 - 0.9 * n / all_steps)
                    self.weights[k] -= (
                        pace * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)
                    ).astype(np.float32)
        return self


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CODES[np.minimum(points, OTHER)]


# ---------------------------------------------------------------- labelled spans


def _number(rng: np.random.Generator, digits: int) -> str:
    return "".join(map(str, rng.integers(0, 10, digits)))


def _card_number(rng: np.random.Generator) -> str:
    body = str(rng.integers(3, 7)) + _number(rng, int(rng.integers(12, 16)) - 1)
    digits = next(body + str(d) for d in range(10) if luhn(body + str(d)))
    gap = rng.choice(["", "", " ", "-"])
    return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def made_span(rng: np.random.Generator, kind: str, words: list[str]) -> str:
    """A span of a kind, of many shapes."""
    word = lambda: rng.choice(words)
    if kind == "email":
        local = rng.choice(["", word() + ".", word() + "_"]) + word() + rng.choice(["", _number(rng, 2)])
        return f"{local}@{word()}{rng.integers(0, 10)}.{rng.choice(['com', 'net', 'org', 'example.com'])}"
    if kind == "ip":
        return ".".join(map(str, rng.integers(0, 256, 4)))
    if kind == "card":
        return _card_number(rng)
    parts = [_number(rng, int(n)) for n in rng.choice([[3, 3, 4], [2, 3, 4], [3, 4, 3]])]
    return f"+{rng.integers(1, 99)}{rng.choice(['', ' ', '-'])}" + rng.choice(["", " ", "-", "."]).join(parts)


def missed_span(rng: np.random.Generator, kind: str, words: list[str]) -> tuple[str, str, str]:
    """A span that the rules miss, between what stands right before and right after it."""
    if kind == "email":
        word, host, end = rng.choice(words), rng.choice(words), rng.choice(["com", "net", "org"])
        mark = rng.choice(list("éøüß"))
        address = (f"{word}{mark}@{host}{rng.integers(0, 10)}.{end}", f"{word}@{mark}{host}.{end}",
                   f"{word}.{host}@{host[:2]}{mark}{host[2:]}.{end}")
        return "", str(rng.choice(address)), ""
    made = made_span(rng, kind, words)
    if kind == "ip":
        return f"{rng.integers(256, 10000)}.", made, ""
    beside = _number(rng, int(rng.integers(1, 4)))
    if kind == "card":
        form = rng.integers(0, 3)
        if form == 0:
            digits = _digits(made)
            return "", ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), ""
        return (f"{beside} ", made, "") if form == 1 else ("", made, f" {beside}")
    if rng.integers(0, 3) == 0:
        return "", made, f" {_number(rng, int(rng.integers(7, 10)))}"
    area, one, two = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    far = f"0{_number(rng, int(rng.integers(2, 5)))}"
    return "", str(rng.choice([
        f"({area}) {one}-{two}", f"({area}) {one} {two}", f"({area}){one}-{two}", f"{area}-{one}-{two}",
        f"{area}.{one}.{two}", f"{area} {one} {two}", f"{far}-{one}{two}", f"{far} {one}{two}", f"({far}) {one}{two}",
        f"{far} {one} {two}",
    ])), ""


def _other_number(rng: np.random.Generator) -> str:
    """Digits that are no personal data."""
    return str(rng.choice([
        _number(rng, int(rng.integers(9, 13))), f"{rng.integers(1, 999)},{_number(rng, 3)},{_number(rng, 3)}",
        f"{rng.integers(2000, 2030)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02} {rng.integers(0, 24):02}:{rng.integers(0, 60):02}",
        f"{rng.integers(1900, 2030)}-{rng.integers(1900, 2030)}", " ".join(map(str, rng.integers(0, 100, 6))),
        f"{_number(rng, 5)}.{_number(rng, 6)}", f"{rng.integers(1, 29):02}.{rng.integers(1, 13):02}.{rng.integers(2000, 2030)}",
        "%040x" % int.from_bytes(rng.bytes(20), "big"), "password=%018x" % int.from_bytes(rng.bytes(9), "big"),
        f"{rng.integers(1900, 2030)}", f"{rng.integers(0, 100)}.{rng.integers(0, 100)}%",
        f"{rng.integers(2000, 2030)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02}",
        f"{rng.integers(0, 24)}:{rng.integers(0, 60):02}", f"v{rng.integers(0, 9)}.{rng.integers(0, 9)}.{rng.integers(0, 9)}",
        _number(rng, int(rng.integers(1, 9))), f"@{_number(rng, 3)}",
    ]))


def labelled_windows(snippets: list[str], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of one window for every snippet, most with a span set into them.

    What was set in is tagged as it was set in, whatever the rules make of it; they tag the rest.
    """
    words = sorted({w.lower() for s in snippets for w in s.split() if w.isascii() and w.isalpha()})
    words = words or ["user", "mail", "name"]
    codes = np.full((len(snippets), WINDOW), BEYOND, np.uint8)
    tags = np.zeros((len(snippets), WINDOW), np.int64)
    for row, snippet in enumerate(snippets):
        kind = (*KINDS, "none", "none")[row % 6]
        before = after = ""
        if kind == "none":
            made = _other_number(rng)
        elif rng.integers(0, 2):
            before, made, after = missed_span(rng, kind, words)
        else:
            made = made_span(rng, kind, words)
        at = int(rng.integers(0, max(1, min(len(snippet), WINDOW) - len(before + made + after))))
        glued = kind == "email" or before or snippet[at - 1 : at].isdigit()
        head = snippet[:at] + (" " if glued else rng.choice([" ", " ", " ", "", "\n"])) + before
        start, end = len(head), len(head) + len(made)
        tail = after + rng.choice([" ", " ", ". ", ", ", "\n", "###"]) + snippet[at:]
        text = (head + made + tail)[:WINDOW]
        codes[row, : len(text)] = codes_of(text)
        spans = rule_spans(text)
        if kind != "none":
            spans = [s for s in spans if s[2] <= start or s[1] >= end] + [(kind, start, min(end, WINDOW))]
        for name, first, last in spans:
            tag = 1 + 2 * KINDS.index(name)
            tags[row, first:last] = tag + 1
            tags[row, first] = tag
    return codes, tags


def snippets_of(documents: DataFrame, most: int = SNIPPETS) -> list[str]:
    """At most so many short cuts from anywhere in the documents, the same in every run."""
    h = F.xxhash64("doc_id", "text")
    start = F.pmod(h, F.greatest(F.char_length("text") - WINDOW, F.lit(1))).cast("int") + 1
    chosen = (
        documents.filter(F.char_length("text") > 0)
        .select(h.alias("h"), F.substring(F.col("text"), start, F.lit(WINDOW)).alias("snippet"))
        .orderBy("h", "snippet")
        .limit(most)
    )
    return [row.snippet for row in chosen.collect()]  # bounded by `most`


def train(documents: DataFrame, seed: int = 7) -> Tagger | None:
    snippets = snippets_of(documents)
    if not snippets:
        return None
    rng = np.random.default_rng(seed)
    snippets = 2 * (snippets * (SNIPPETS // len(snippets) + 1))[:SNIPPETS]  # two windows of each
    return Tagger.fresh(rng).fit(*labelled_windows(snippets, rng), rng)


# ---------------------------------------------------------------- whole texts


def _window_starts(text: str) -> np.ndarray:
    """Starts of the windows on the grid that hold a digit or an @."""
    cells = np.unique(np.fromiter((m.start() for m in _SIGNS.finditer(text)), np.int64) // STRIDE)
    if not len(cells):
        return cells
    return np.unique(np.concatenate([cells, np.maximum(cells - 1, 0)])) * STRIDE


def _joined(starts: np.ndarray, tags: np.ndarray) -> Iterator[Span]:
    """Spans over all windows of a text: for every character the tag of the window whose nearer
    edge is furthest from it."""
    places = (starts[:, None] + np.arange(WINDOW)).ravel()
    inside = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW))
    order = np.lexsort((-np.tile(inside, len(starts)), places))
    places, tags = places[order], tags.ravel()[order]
    first = np.ones(len(places), bool)
    first[1:] = places[1:] != places[:-1]
    places, tags = places[first], tags[first]
    kind, begins = (tags - 1) // 2, tags % 2 == 1
    fresh = np.ones(len(tags), bool)
    fresh[1:] = begins[1:] | (kind[1:] != kind[:-1]) | (places[1:] != places[:-1] + 1)
    edges = np.append(np.flatnonzero(fresh), len(tags))
    for a, b in zip(edges, edges[1:], strict=False):
        if tags[a]:
            yield KINDS[kind[a]], int(places[a]), int(places[b - 1]) + 1


def all_spans(texts: list[str], tagger: Tagger | None, at_once: int = 1024) -> list[tuple[list[Span], list[Span]]]:
    """For every text the spans of the rules, and with those that the model adds."""
    ruled = [rule_spans(text) if _SIGNS.search(text) else [] for text in texts]
    result = [(spans, spans) for spans in ruled]
    if tagger is None:
        return result
    waiting: list[tuple[int, np.ndarray]] = []
    windows: list[np.ndarray] = []

    def settle() -> None:
        tags = np.concatenate([
            tagger.decode(np.stack(windows[i : i + at_once], axis=1)).T
            for i in range(0, len(windows), at_once)
        ])
        done = 0
        for row, starts in waiting:
            own = _joined(starts, tags[done : done + len(starts)])
            done += len(starts)
            result[row] = (ruled[row], _with(ruled[row], own, texts[row]))
        waiting.clear()
        windows.clear()

    for row, text in enumerate(texts):
        starts = _window_starts(text)
        if not len(starts):
            continue
        codes = np.full(len(text) + WINDOW, BEYOND, np.uint8)
        codes[: len(text)] = codes_of(text)
        waiting.append((row, starts))
        windows += [codes[s : s + WINDOW].copy() for s in starts]
        if len(windows) >= 8 * at_once:
            settle()
    if waiting:
        settle()
    return result


def _with(base: list[Span], added: Iterator[Span], text: str) -> list[Span]:
    taken = sorted((start, end) for _, start, end in base)
    starts = [start for start, _ in taken]
    reach = np.maximum.accumulate([end for _, end in taken]) if taken else []
    more = []
    for kind, start, end in added:
        while end > start and text[end - 1 : end].isspace():
            end -= 1
        before = np.searchsorted(starts, end)
        if end <= len(text) and end > start and not (before and reach[before - 1] > start):
            if _sound(kind, text[start:end]):
                more.append((kind, start, end))
    return sorted([*base, *more], key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if more else base


def _told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# ---------------------------------------------------------------- operator


def span_column(text: Column | str, tagger: Tagger | None) -> Column:
    """Struct of n_email, n_ip, n_card, n_phone, base and spans (texts) of a whole text."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, spans in all_spans([text or "" for text in texts], tagger):
            kinds = [kind for kind, _, _ in base]
            rows.append((*(kinds.count(kind) for kind in KINDS), _told(base), _told(spans)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return found(text)


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, the rules' counts and digest, and all spans of every document."""
    documents = documents.select("doc_id", "text")
    found = documents.withColumn("_found", span_column("text", train(documents)))
    f = F.col("_found")
    return found.select(
        "doc_id", *(f[f"n_{kind}"].alias(f"n_{kind}") for kind in KINDS),
        F.sha2(f["base"], 256).alias("base_sha256"), f["spans"].alias("spans"),
    )


def masked(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars follows."""
    tagger = train(documents.select("doc_id", "text"))

    @F.pandas_udf("string")
    def replaced(texts: pd.Series) -> pd.Series:
        found = all_spans([text or "" for text in texts], tagger)
        return pd.Series([
            _masked(text, spans) if spans else text
            for text, (_, spans) in zip(texts, found, strict=True)
        ], dtype=object)

    result = documents.withColumn("text", replaced("text"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        result = result.withColumn(
            "n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
        )
    return result.select(*documents.columns)


def _masked(text: str, spans: list[Span]) -> str:
    """Overlapping spans of several kinds become one, named by the one that starts first."""
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])
