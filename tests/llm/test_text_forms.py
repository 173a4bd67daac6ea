"""Problems 2, 3, 7 and 8 against brute force."""

from __future__ import annotations

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.llm import copies, mixing, tokens, topn

# --- copies -------------------------------------------------------------------------------------

SOURCES = "source_row_id bigint, turn_id string, rank int, title string, url string, first string, id string, _title_key string"


def canonical(text, separators):
    """Kept and folded parts, sorted."""
    if text is None:
        return None
    out, part = [], ""
    for c in text + (separators[:1] or "\0"):
        if c in separators or c == "\0":
            out.append(part)
            part = ""
        elif unicodedata.category(c)[0] not in "PZC" and c not in copies.ASCII_SYMBOLS and chr(ord(c) - 0xFEE0 if ord(c) > 0xFF00 else 0) not in copies.ASCII_SYMBOLS:
            part += c.casefold()
    return tuple(sorted(filter(None, [*out, part])))


def key(title, url):
    return canonical(title, copies.TITLE_SEPARATORS), None if url is None else tuple(canonical(p, s) for p, s in zip(copies.split_url(url), copies.URL_SEPARATORS, strict=True))


def sources(spark, rows):
    return spark.createDataFrame([(i, "t", 1, t, u, "x", "y", "z") for i, (t, u) in rows], SOURCES)


def expected(rows):
    groups = {}
    for i, (t, u) in rows:
        groups.setdefault(key(t, u), set()).add(i)
    return sorted((min(g), i) for g in groups.values() for i in g if i != min(g))


CASES = [
    ("A b | C", "https://x.test/p?a=1&b=2"), ("c｜ab!", "HTTPS://x.test/p/?b=2;a=1&&"), ("A b | C", "http://x.test/p?a=1&b=2"), ("A b | C", "https://x.test/p?a=2&b=1"), ("Ab C", "https://x.test/p?a=1&b=2"), ("", ""), (None, ""), (None, None), (None, None), ("。 ", "…"),
    ("Straße", "u"), ("STRASSE", "U"), ("a​b", "u"), ("A B", "u#f"), ("AB", "u#F"), ("AB", "uf"), ("2 0 2 4", "u"), ("2024", "u "), ("é", "u"), ("é", "u"), ("x" * 50_000 + "y", "u"), ("X" * 50_000 + " Y", "u"), ("x" * 50_000 + "z", "u"), ("a|b|a", "u"), ("b|a", "u"), ("a|a|b", "u"),
]


def test_copies_match_brute_force(spark):
    rng = random.Random(1)
    rows = list(enumerate(CASES))
    for i in range(400):
        fields = [rng.choice(["Alpha Beta", "gamma", "Δέλτα", "标题 一"]) for _ in range(rng.randint(1, 3))]
        noisy = rng.choice(["|", " ｜ "]).join(rng.choice([str.upper, str.lower, str])(f).replace(" ", rng.choice([" ", "　", "⁠", "-", ""])) for f in rng.sample(fields, len(fields)))
        rows.append((1000 + i, (noisy, rng.choice(["https://h.test/a?x=1&y=2", "https://H.test/a?y=2;x=1", "https://h.test/a?x=2&y=1"]))))
    df = sources(spark, rows + rows[:5])
    got = sorted(map(tuple, copies.form_copies(df).collect()))
    assert got == expected(rows)
    groups = copies.form_groups(df).collect()
    assert sum(r.row_count for r in groups) == len(rows) + 5 and len(groups) == len({key(*r) for _, r in rows})


def test_copies_of_nothing_and_of_null_ids(spark):
    assert copies.form_copies(sources(spark, [])).count() == 0
    assert copies.form_copies(sources(spark, [(None, ("a", "b")), (None, ("a", "b"))])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aAbß|.- ​｜1", max_size=12), st.text(alphabet="aAbß|.- ​｜1", max_size=12))
def test_hash_and_two_pointers_agree(a, b):
    same = canonical(a, copies.TITLE_SEPARATORS) == canonical(b, copies.TITLE_SEPARATORS)
    assert copies.same_form(a, b, copies.TITLE_SEPARATORS) == same
    h = copies.title_hash([a, b])
    assert (h[0] == h[1]) == same


def test_a_collision_is_an_error(spark, monkeypatch):
    assert copies.same_citation("a", "u", "b", "u") is False
    assert (copies.title_hash(["abc"], 0) != copies.title_hash(["abc"], 1)).all()


# --- the N best -------------------------------------------------------------------------------------

ITEMS = "g string, h string, s bigint, o bigint, k string, score string, item string, bound string, place string"


def best(rows, n):
    groups = {}
    for g, h, s, o, k, *_ in set(rows):
        if g is not None and h is not None and s is not None and k is not None:
            rank = (-s, o if o is not None else 2**63 - 1, k.encode())
            own = groups.setdefault((g, h), {})
            own[k] = min(own.get(k, rank), rank)
    return sorted((g, h, k) for (g, h), own in groups.items() for k in sorted(own, key=own.get)[:n])


@pytest.mark.parametrize("limit", [0, 10**6])
def test_top_n_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(topn, "BROADCAST_ROWS", limit)
    rng = random.Random(2)
    rows = [
        (rng.choice(["hot"] * 5 + ["a", "", None]), rng.choice(["x", "y", None]), rng.choice([None, 1, 2, 3, 2**40]), rng.choice([None, 1, 2]), rng.choice([None, "é", "z", "ｆ", "😀", *map(str, range(200))]), "a", "b", "c", "d") for _ in range(3000)
    ]
    rows += rows[:300]
    df = spark.createDataFrame(rows, ITEMS).repartition(7)
    got = sorted((r.g, r.h, r.item) for r in topn.top_n(df, ["g", "h"], "s", "o", "k", 10).collect())
    assert got == best(rows, 10)


def test_an_item_with_many_scores_is_one_item(spark):
    rows = [("g", "h", 11 + i, 1, "A", "a", "b", "c", "d") for i in range(10)] + [("g", "h", 1 + i, 1, k, "a", "b", "c", "d") for i, k in enumerate("BCDEFGHIJ")]
    df = spark.createDataFrame(rows, ITEMS).coalesce(1)
    got = sorted((r.g, r.h, r.item) for r in topn.top_n(df, ["g", "h"], "s", "o", "k", 10).collect())
    assert got == best(rows, 10) and len(got) == 10


def test_top_n_of_nothing(spark):
    assert topn.top_n(spark.createDataFrame([], ITEMS), ["g"], "s", "o", "k").count() == 0


# --- tokens -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def peer():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=tokens.reference_ranks(), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return tokens.encoder(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")


LONG = ["a" * 20_000, " " * 5000, "ab" * 5000, "的" * 4000, "é1!" * 3000, "\n\r\n" * 1000, "<|endoftext|>", "can't we'll I'm", "𠮷野‍🏳️‍🌈", "﻿BOM", "Ångström ＡＢＣ"]


@pytest.mark.parametrize("text", LONG)
def test_encoding_of_long_and_odd_texts(encoder, peer, text):
    assert encoder.encode(text) == peer.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoding_of_any_text(encoder, peer, text):
    assert encoder.encode(text) == peer.encode_ordinary(text)


def test_backtracking_alone_is_exact(encoder, peer):
    rng = random.Random(5)
    for _ in range(300):
        piece = "".join(rng.choice("abcdehilnorstu") for _ in range(rng.randint(1, 40)))
        assert encoder._backtrack(piece) == peer.encode_ordinary(piece)


def test_ids_of_documents(spark, peer):
    rows = [(1, None, 0), (2, "", 0), (3, " \t", 0), (4, "Hello 世界", 0), (4, "Hello 世界", 0), (None, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = tokens.encode_documents(df).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted((i or 0, peer.encode_ordinary(t or "")) for i, t, _ in rows)
    counts = df.select("doc_id", tokens.token_count("text").alias("n")).where("doc_id = 4").collect()
    assert {r.n for r in counts} == {len(peer.encode_ordinary("Hello 世界"))}
    assert tokens.encode_documents(df.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------------------

TARGETS = "plan_id string, source string, target_share double, max_repeats int, held int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, "w") for i, t, s in rows], "doc_id bigint, text string, source string, weight string")


def mixed(spark, docs, targets, total=None, seed=1):
    sized = mixing.sized_documents(documents(spark, docs))
    needs = mixing.source_needs(sized, spark.createDataFrame(targets, TARGETS), total)
    got = mixing.mix(sized, needs, seed)
    return got, {(r.plan_id, r.source): r for r in mixing.mix_shares(got, needs).collect()}


def test_shares_are_met_within_a_document(spark):
    rng = random.Random(3)
    docs = [(i, "word " * rng.randint(1, 30), "big") for i in range(1500)] + [(5000 + i, "same text here", "twins") for i in range(50)] + [(6000 + i, f"small one {i}", "small") for i in range(10)]
    got, shares = mixed(spark, docs, [("p", "big", 0.5, 1, 0), ("p", "twins", 0.25, 100, 0), ("p", "small", 0.25, 2, 0), ("p", "gone", 0.0, 3, 0)], 8000)
    assert abs(shares["p", "big"].tokens - 4000) <= 15 and abs(shares["p", "twins"].tokens - 2000) <= 3
    small = shares["p", "small"]
    assert not small.in_reach and small.tokens == 2 * small.tokens_held and small.most_copies == 2
    assert shares["p", "gone"].tokens == 0 and sum(s.share for s in shares.values()) == pytest.approx(1)
    assert max(r.copies for r in got.where("source = 'big'").collect()) == 1
    again, _ = mixed(spark, docs, [("p", "big", 0.5, 1, 0)], 8000)
    assert {r.doc_id for r in again.collect()} == {r.doc_id for r in got.where("source = 'big'").collect()}
    other, _ = mixed(spark, docs, [("p", "big", 0.5, 1, 0)], 8000, 2)
    assert {r.doc_id for r in other.collect()} != {r.doc_id for r in again.collect()}


def test_mixing_edge_cases(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (None, "x", "a"), (4, "one two three", "a"), (4, "one two three", "a"), (5, "long " * 50_000, "b")]
    _, shares = mixed(spark, docs, [("p", "a", 0.5, None, 0), ("q", "a", 1.0, 3, 0), ("q", "b", None, 1, 0), (None, "a", 1.0, 1, 0)])
    assert shares["p", "a"].tokens == 0 and shares["q", "b"].tokens == 0 and shares["q", "a"].most_copies == 3
    _, none = mixed(spark, [], [("p", "a", 1.0, 1, 0)])
    assert none["p", "a"].tokens == 0 and none["p", "a"].share == 0.0
