"""The parts that run inside tasks, against plain forms and held-out data."""


import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from kvartal.llm import chats, neardup, packing, pii, quality, tokenfile, tokens
from kvartal.llm.words import WordHashes
from tests.llm import plain

ODD = st.text(st.sampled_from("ab 's\n\t.1é#Áß\r\\<|im_start>/[INST]  Σ漢😀"), max_size=30)


# -- packing ---------------------------------------------------------------


@given(st.lists(st.integers(1, 99), max_size=60), st.integers(100, 300))
@settings(deadline=None, max_examples=60)
def test_windows_hold_all_within_capacity(lengths, capacity):
    lengths = np.array(lengths, np.int64)
    windows = packing.parted(lengths, capacity)
    assert len(windows) == len(lengths)
    assert np.bincount(windows, lengths).max(initial=0) <= capacity


def test_differencing_by_hand():
    # 8 7 | 6 5 4 in two windows: the method gives 16 and 14
    found = packing.differenced(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(found, [8, 7, 6, 5, 4])) == [14, 16]


def test_windows_are_nearly_equal():
    lengths = np.random.default_rng(1).integers(1, 900, 3000)
    sums = np.bincount(packing.parted(lengths, 4096), lengths)
    assert sums.min() > 0.97 * 4096


# -- tokens ----------------------------------------------------------------


@pytest.mark.parametrize("name,space", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoders_equal_the_tokenizer(name, space):
    encoder = tokens.Encoder(public_tokenizers.path(name), space)

    @given(ODD)
    @settings(deadline=None, max_examples=400)
    def check(text):
        assert encoder.of(text) == encoder.whole(text)

    check()
    plain_tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    unknown = [chr(c) for c in range(0x80, 0x30000) if unicodedata.category(chr(c)) == "Cn"][::97]
    for text in ("x<|endoftext|> y", "<|STARTOFTEXT|>", "a <|startoftext|>b", " ".join(unknown), "a\u0558b c\u088f. \u0c5c"):
        ids = plain_tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.of(text) == np.array(ids, "<u4").tobytes()
    for text in ("", "x<|endoftext|> <|startoftext|>", "İstanbul's we'LL", "a \n b", plain.prose(4, 500)):
        assert encoder.of(text) == encoder.whole(text)
    assert encoder.of(None) == b""


# -- index -----------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_index_is_minimal_and_perfect(n):
    ids = np.random.default_rng(n).choice(10**12, n, replace=False) - 5 * 10**11
    occurrences = np.arange(n) % 3
    seeds, slots, prints = tokenfile.build_index(ids, occurrences)
    assert sorted(slots) == list(range(n))
    assert len(seeds) == max(1, n // tokenfile.BUCKET_KEYS)


# -- quality ---------------------------------------------------------------


@given(ODD)
@settings(deadline=None)
def test_counts(text):
    found = quality.statistics(text, WordHashes())
    assert (*found[:5],) == plain.base_counts(text)[:5]


def test_trees_learn_and_keep_directions():
    rng = np.random.default_rng(3)
    rows = rng.random((2000, 3))
    good = ((rows[:, 0] < 0.5) & (rows[:, 2] > 0.2)).astype(float)
    good = np.where(rng.random(2000) < 0.1, 1 - good, good)
    trees = quality.fit_trees(rows, good, [-1, 0, 1])
    held = rng.random((500, 3))
    truth = (held[:, 0] < 0.5) & (held[:, 2] > 0.2)
    assert ((trees.chance(held) > 0.5) == truth).mean() > 0.95
    for feature, direction in ((0, -1), (2, 1)):
        for row in held[:40]:
            line = np.repeat(row[None], 50, axis=0)
            line[:, feature] = np.linspace(0, 1, 50)
            assert (np.diff(trees.chance(line)) * direction >= -1e-12).all()


# -- personal data ---------------------------------------------------------


@given(st.text(st.sampled_from("a.@-+ ()0123459\n"), max_size=40))
@settings(deadline=None, max_examples=500)
def test_rules(text):
    assert sorted(pii.rule_spans(text)) == sorted(plain.base_spans(text))


def test_tagger_on_held_out_spans():
    prose = ["".join(c for c in plain.prose(i, 30) if not c.isdigit()) for i in range(1500)]
    snippets = [text[i % 7 :][:96] for i, text in enumerate(prose)]
    tagger = pii.Tagger.fresh(np.random.default_rng(1)).fit(
        *pii.labelled_windows(snippets, np.random.default_rng(2)), np.random.default_rng(3)
    )
    codes, tags = pii.labelled_windows(snippets[:400], np.random.default_rng(4))
    found = tagger.decode(codes.T).T
    both = ((found > 0) & (tags > 0)).sum()
    assert both / (tags > 0).sum() > 0.9
    assert both / (found > 0).sum() > 0.9
    # far apart and across window borders, base spans stay and nothing else is told
    text = (plain.prose(1, 40).replace("1", "") + " ") * 20
    planted = text[:1000] + " jo.doe@mail1.example.com " + text[1000:2023] + " +49 170 123 4567 " + text[2023:]
    (base, spans), = pii.all_spans([planted], tagger)
    assert base == plain.base_spans(planted) and set(base) <= set(spans)
    # a card that the rule misses, for it runs into other digits
    (base, spans), = pii.all_spans([text[:500] + " 12 4539578763621486 " + text[500:]], tagger)
    assert all(span in spans for span in base)


def test_tagger_finds_spans_that_the_rules_miss():
    prose = ["".join(c for c in plain.prose(i, 30) if not c.isdigit()) for i in range(1700)]
    snippets = [text[i % 7 :][:96] for i, text in enumerate(prose[:1500])]
    tagger = pii.Tagger.fresh(np.random.default_rng(1)).fit(
        *pii.labelled_windows(2 * snippets, np.random.default_rng(2)), np.random.default_rng(3)
    )
    planted = [
        ("12 ", "4539578763621486", "card"), ("", "4539.5787.6362.1486", "card"), ("", "(555) 123-4567", "phone"),
        ("", "030-1234567", "phone"), ("", "jos\u00e9@mail1.org", "email"), ("", "+49 170 1234567", "phone"),
    ]
    hit = 0
    for i, (before, made, kind) in enumerate(20 * planted):
        head = prose[1500 + i][:120] + " " + before
        text = head + made + (" 20240506 " if made[0] == "+" else " ") + prose[1600 - i]
        (base, spans), = pii.all_spans([text], tagger)
        told = (kind, len(head), len(head) + len(made))
        assert told not in base
        hit += told in spans
    assert hit >= 0.85 * 20 * len(planted)
    # digits that are no personal data
    wrong = 0
    for i, other in enumerate(20 * ["2024-05-06 12:30", "1990-2005", "123456789012", "1,234,567", "v1.2.3"]):
        (base, spans), = pii.all_spans([f"{prose[1500 + i]} {other} {prose[i]}"], tagger)
        wrong += spans != base
    assert wrong <= 5


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger.fresh(rng, hidden=3)
    tagger.weights = {k: v.astype(np.float64) + rng.normal(0, 0.2, v.shape) for k, v in tagger.weights.items()}
    codes, tags = rng.integers(0, 129, (6, 2)).astype(np.uint8), rng.integers(0, pii.TAGS, (6, 2))

    def loss():
        scores, step = tagger.emissions(codes).astype(np.float64), tagger.weights["step"]
        ahead = scores[0]
        for t in range(1, len(scores)):
            ways = ahead[:, :, None] + step
            ahead = np.log(np.exp(ways).sum(1)) + scores[t]
        rows = np.arange(2)
        path = sum(scores[t, rows, tags[t]] for t in range(6)) + sum(step[tags[t - 1], tags[t]] for t in range(1, 6))
        return (np.log(np.exp(ahead).sum(1)) - path).mean()

    slopes = tagger.slopes(codes, tags)
    for name in ("out", "step", "on_again", "back_bias"):
        at = tuple(rng.integers(0, s) for s in tagger.weights[name].shape)
        kept = tagger.weights[name][at]
        tagger.weights[name][at] = kept + 1e-2
        high = loss()
        tagger.weights[name][at] = kept - 1e-2
        low = loss()
        tagger.weights[name][at] = kept
        assert slopes[name][at] == pytest.approx((high - low) / 2e-2, rel=0.05, abs=2e-3)


# -- near duplicates -------------------------------------------------------


def test_bands_and_pruning_keep_near_pairs():
    """Of 400 pairs a little above the threshold none is lost; far pairs mostly are."""
    rng = np.random.default_rng(5)
    kept = pruned = 0
    for _ in range(400):
        pool = rng.integers(0, 2**63, 1200).astype(np.uint64)
        near = [neardup.signature(pool[a : a + 1000]) for a in (0, 130)]  # 870 / 1130 = 0.77
        far = [neardup.signature(pool[a : a + 700]) for a in (0, 300)]  # 400 / 1000 = 0.4
        share = np.intersect1d(*(neardup.band_keys(s) for s in near))
        kept += len(share) > 0 and neardup.promising(near[0][None], near[1][None])[0]
        pruned += not neardup.promising(far[0][None], far[1][None])[0]
    assert kept == 400
    assert pruned > 390


def test_posterior_bounds_by_simulation():
    rng = np.random.default_rng(6)
    matches = rng.binomial(40, 0.75, 200_000)
    least = neardup.least_matches()[40]
    assert (matches < least).mean() < 1e-4


# -- chats -----------------------------------------------------------------


@given(ODD, ODD)
@settings(deadline=None, max_examples=300)
def test_turns_round_trip(role, text):
    formatted, start, end = chats.format_turn(role, text)
    assert chats.parse_turn(formatted) == (role, text)
    assert formatted.count(chats.START) == 1 and formatted.count(chats.END) == 1
    assert len(chats.CONTROL.findall(formatted)) == 2
    formatted, start, end = chats.format_turn("assistant", text)
    assert chats.unescape(formatted[start:end]) == text
