"""Plain Python forms of the operators, and small tables with every odd row."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row long, size long, _row long, _quality long, found string, start long"


def prose(seed: int, n: int) -> str:
    words = "the of and reading water stone river light paper green under winter house".split()
    return " ".join(words[(seed * 7 + i * i * (seed % 5 + 1) + i) % len(words)] + str((seed + i) % 17 or "") for i in range(n))


def odd_documents(spark):
    """Nulls, empty and long texts, ties, copies, near copies and columns of clashing names."""
    base = prose(1, 120)
    near = base + " one more ending"
    rows = [
        (1, base), (2, None), (3, ""), (4, " \n\t "), (5, "a"), (6, "A  b\nc d"), (7, "a b c d"),
        (8, base), (8, base), (9, near), (10, base.upper()), (11, prose(2, 30_000)), (None, prose(3, 40)),
        (None, prose(3, 40)), (12, "mail me at jo.doe@mail1.example.com or +49 170 123 4567, 10.0.0.1"),
        (13, "card 4539578763621486 and 4539578763621487; 1.2.3.4.5 300.1.1.1"), (14, "x" * 50_000),
        (15, "# * $ % & | < >\n# * $ % & | < >\n\n# * $ % & | < >"), (16, "é ü 漢字 😀. ß!\n" * 30),
        (17, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" password=531ccd051a92ebcb68'),
        (18, "x<|endoftext|> y <|STARTOFTEXT|>z <|startoftext|>"), (2**53 + 1, prose(3, 41) + " \u0558a\u088f \u0c5c"),
    ]
    return spark.createDataFrame(
        [(i, t, "en", [None, "a", "b", "ä"][n % 4], len(t) if t else None, 5, 6, 7, 8, "f", 9)
         for n, (i, t) in enumerate(rows)],
        DOCUMENTS,
    )


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def base_counts(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    again = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    n = len(found)
    return (
        n, sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(again), n < 10 or 100 * len(again) > 20 * n,
    )


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    only = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(only(s)) <= 19 and luhn(only(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(only(s)) <= 15),
    }
    return [
        (kind, *m.span()) for kind, (pattern, holds) in kinds.items()
        for m in re.finditer(pattern, text) if holds(m[0])
    ]


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(sets, ids):
    """Smallest id of every document's group, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    members = {}
    for i in range(len(sets)):
        members.setdefault(find(i), []).append(i)
    return [
        min((ids[j] for j in members[find(i)] if ids[j] is not None), default=None) for i in range(len(sets))
    ], [find(i) for i in range(len(sets))]
