"""Problem 4's field on planted defects whose wording is neither in the bank nor in the patterns."""

from __future__ import annotations

import os
import random
import re

import pandas as pd
import pytest

from citeloom.llm import pairs

DATA = "/root/testdata/sf0.1/qwen_answers.parquet"
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="the test tables are not here")

HELD_OUT = {
    "zh": ("很抱歉，关于品牌的话题我没法发表意见。", "按照规范，我需要跳过这类问题，请谅解。", "对这一点我暂时不作判断，也没法解答。", "遗憾的是，我不参与这类讨论。", "抱歉，具体品牌不在我可以说明的内容之内。"),
    "en": ("I'd rather not discuss particular brands here.", "I'm afraid this is something I have to pass on, sorry.", "My guidelines don't let me take a position on that.", "Unfortunately, giving an opinion here isn't possible for me."),
    "de": ("Zu dieser Frage möchte ich mich leider nicht äußern.", "Eine Einschätzung zu einzelnen Marken gebe ich nicht ab.", "Das liegt außerhalb meiner Aufgaben, es tut mir leid."),
    "fr": ("Je préfère ne pas donner d'avis sur ce sujet.", "Désolé, cela dépasse mon rôle, je m'abstiens.", "Je n'ai malheureusement pas la possibilité de me prononcer."),
    "es": ("Prefiero no dar opiniones sobre este tema.", "Lo siento, esta pregunta va más allá de mi función.", "Lamentablemente no tengo nada que decir aquí."),
}


@pytest.fixture(scope="module")
def rows():
    table = pd.read_parquet(DATA).drop_duplicates("turn_id").sort_values("turn_id")
    return [(q, a, bool(a) and pairs.inspect(a)[0] == "cut") for q, a in zip(table.question, table.answer, strict=True)]


@pytest.fixture(scope="module")
def model(rows):
    return pairs.train(rows[:3000])


def cases(rows):
    """(question, answer, cut, defect) of rows that were not trained on."""
    rng, bare = random.Random(11), pairs.prior()
    sound = [(q, a) for q, a, c in rows[3000:] if q and a and not c and pairs.defect(q, a, c, *bare) is None]
    out = []
    for i, (q, a) in enumerate(sound):
        lang = pairs.expected_language(q)
        if i % 4 == 0 and lang in HELD_OUT:
            out.append((q, " ".join(rng.sample(HELD_OUT[lang], rng.randint(1, 2))), False, "refusal"))
        elif i % 4 == 1:
            core = re.sub(r"[?？。.!]", "", q)
            out.append((q, rng.choice(["问：{q}", "{q}……", "「{q}」", "Re: {q}", "{q} {q} {q}", "Frage: {q}"]).format(q=core), False, "copy"))
        elif i % 4 == 2:
            q2, a2 = sound[rng.randrange(len(sound))]
            wanted, other = pairs.expected_language(q), pairs.language(pairs.prose(a2))
            out.append((q, a2, False, "wrong_language" if wanted and other and wanted != other and len(a2) > 40 else None))
        else:
            out.append((q, a, False, None))
    return out


def rates(model, made):
    found = model.defects([(q, a, c) for q, a, c, _ in made])
    out = {}
    for kind in ("refusal", "copy", "wrong_language"):
        hit = sum(f == kind == k for f, (*_, k) in zip(found, made, strict=True))
        out[kind] = (hit / sum(k == kind for *_, k in made), hit / max(1, sum(f == kind for f in found)))
    return out


def test_held_out_wordings(rows, model):
    made = cases(rows)
    trained = rates(model, made)
    untrained = rates(pairs.Model(pairs.Lexicon(), *pairs.prior()), made)
    print("recall and precision, trained", trained, "prior alone", untrained)
    assert trained["refusal"][0] > 0.7 and trained["refusal"][1] > 0.97 and untrained["refusal"][0] < 0.6
    assert trained["copy"][0] > 0.95 and trained["copy"][1] > 0.98
    assert trained["wrong_language"][0] > 0.9 and trained["wrong_language"][1] > 0.9


def test_labels_are_not_what_the_patterns_say(rows):
    made = pairs.planted(rows[:800])
    refused = [(q, a, tags) for q, a, _, tags in made if set(tags) == {"refusal"}]
    unseen = 0
    for q, a, _ in refused:
        x, _, _ = pairs.clause_features(q, a, False)
        unseen += not x[:, pairs.FEATURES.index("refusing")].any()
    assert len(refused) > 50 and unseen > 0.3 * len(refused)
    assert {t for *_, tags in made for t in tags} == set(pairs.TAGS)


def test_a_copy_has_no_clause_of_an_answer(model):
    q = "云记的茶靠谱吗？"
    assert model.defects([(q, "云记的茶靠谱吗", False), (q, "云记的茶靠谱吗？\n有30位受访者提到口感温和这一点，也有人更看重含量。", False), (q, "靠谱", False), (None, "云记的茶靠谱吗", False)]) == ["copy", None, None, None]


@pytest.mark.parametrize("answer", ["。", "a", "\n\n", "x" * 200_000, "好。" * 50_000, "\ud83d"])
def test_odd_answers(model, answer):
    model.defects([("哪个好？", answer, True), ("", answer, False), (None, answer, False)])


@pytest.mark.skipif(not os.path.exists(DATA), reason="the test tables are not here")
def test_screened_and_unscreened_bits_agree(rows):
    for q, a, c in rows[:1500]:
        if a and (parts := pairs.clauses(a)):
            like = [0.0] * len(parts)
            assert pairs.clause_bits(q, a, c, parts, like) == pairs.clause_bits(q, a, c, parts, like, screen=False)
