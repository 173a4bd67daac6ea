"""Broken question and answer pairs (problem 4).

A linear-chain conditional random field tags the clauses of an answer as answer, refusal, echo,
foreign or unfinished; the coverage of the tags decides the defect of the pair. The field is
trained here on pairs whose tags are known because they were made: sound answers of a bounded
sample of the input (``TRAINING_ROWS``) as they are, and the same with planted defects (refusals of
a bank of wordings, the question in changed form and frame, answers to questions in another
language, cuts). A Gaussian prior around hand-set weights carries it where the input is too small
to learn from. Beside wording patterns the field reads how much a clause's character trigrams look
like refusals, by log odds that are learned from the same sample.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.language import language, prose
from citeloom.llm.screens import _CASES, hints_in  # noqa: F401
from citeloom.llm.templates import template_residue
from citeloom.llm.truncation import find_truncated, inspect

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
#: Rows of the input that the field is trained on at most, and the longest answer among them in characters.
TRAINING_ROWS, TRAINING_CHARS = 3000, 20_000
#: Sound clauses of a language for each of the bank's that let the language be learned.
KNOWN = 5
#: Share of a text's prose that a defect must cover.
COVERAGE = 0.5

# Words of refusals, of their courtesies, and of no content.
REFUSING = (
    r"我?(?:没有办法|无法|不能|不便|不方便|不会|拒绝)(?:就|对|给出|提供|回答|回应|作出|评论|讨论|透露|协助|满足|处理|继续)", r"这个问题我不(?:便|能|方便|会)", r"(?:我|暂时)?不能就", r"暂时不(?:能|便)",
    r"帮不上忙", r"还没学会怎么", r"超出了?我(?:可以|能|的)", r"不在我的(?:能力|服务)范围", r"不予(?:回答|置评)", r"恕(?:我)?(?:不能|无法|难)", r"不便(?:回答|透露|评论)",
    r"\b(?:I|we) (?:can(?:not|'t|’t)|could not|won'?t|will not|am not able to|are not able to|am unable to|have to decline|must decline|decline to)\b", r"\bI (?:won't|cannot|can't|am not) be able to\b", r"\bhave to decline\b", r"\bkeep me from (?:answering|commenting)\b", r"\boutside of what I\b", r"\bnot (?:able|allowed|permitted) to (?:comment|answer|discuss|help|provide)\b",
    r"\b(?:kann|darf|möchte|muss) ich\b[^.]{0,40}\b(?:nicht|keine|passen)\b",
    r"\bich (?:kann|darf|muss)\b[^.]{0,40}\b(?:nicht|keine|passen)\b", r"\bmuss ich hier passen\b", r"\bkeine Auskunft geben\b",
    r"\bje ne (?:peux|suis|pourrai)\b[^.]{0,30}\b(?:pas|plus)\b", r"\bsort de ce que je\b", r"\bil m[’']est impossible\b",
    r"\bje dois (?:décliner|refuser)\b", r"\bno puedo (?:responder|ayudar|opinar|comentar|dar|ofrecer)\b", r"\bqueda fuera de lo que\b",
    r"\bdebo abstenerme\b", r"\bno me es posible\b", r"(?:お答え|回答|コメント)(?:でき|いたしかね|は控え)",
)
COURTESY = (
    r"抱歉|对不起|遗憾|感谢您的提问|感谢提问|敬请谅解|见谅", r"换个(?:问题|话题)|聊点别的|其他方面的内容|问我(?:其他|别的)", r"咨询专业人士", r"(?:避免|以免)给出不准确|带倾向", r"如果愿意，我可以",
    r"以官方渠道发布的为准|直接咨询(?:门店|客服|官方)", r"一般常识",
    r"\b(?:sorry|unfortunately|apologies|thank you for asking|as an assistant)\b",
    r"\b(?:try another question|anything else you need|ask a professional|general shopping tips|one-sided or inaccurate|better contact)\b",
    r"\b(?:leider|tut mir leid|andere Frage|allgemeine Einkaufstipps)\b",
    r"\b(?:désolé|malheureusement|autre question|conseils généraux)\b",
    r"\b(?:lo siento|lamentablemente|otra pregunta|consejos generales)\b", r"申し訳|恐れ入り",
)
NOTHING = ("", "null", "none", "nil", "n/a", "na", "nan", "undefined", "empty", "无", "暂无", "没有", "空", "(null)", "[]", "{}", "<empty>",
    "no answer", "no data", "暂无内容", "暂无数据", "keine angabe", "k.a.", "s/o", "なし", "該当なし")
# Wordings that ask for an answer in a language.
WANTED = {
    "en": ("用英文", "用英语", "in english", "auf englisch", "en anglais", "en inglés", "英語で"),
    "de": ("用德文", "用德语", "in german", "auf deutsch", "en allemand", "en alemán", "ドイツ語で"),
    "fr": ("用法文", "用法语", "in french", "auf französisch", "en français", "en francés", "フランス語で"),
    "es": ("用西班牙文", "用西班牙语", "in spanish", "auf spanisch", "en espagnol", "en español", "スペイン語で"),
    "zh": ("用中文", "用汉语", "in chinese", "auf chinesisch", "en chinois", "en chino", "中国語で"),
    "ja": ("用日文", "用日语", "in japanese", "auf japanisch", "en japonais", "en japonés", "日本語で"),
}
# Whole refusals that are planted in training, by language; their wording is not that of the patterns.
REFUSALS = {
    "zh": (
        "这类话题我不参与讨论。", "很抱歉，我没法为您解答这一点。", "按照使用规范，我不发表意见。", "这一问题暂时不在可以说明的内容之内。", "我需要跳过这个问题，请您谅解。", "对此我只能说声抱歉，恕不作答。", "目前我不对具体品牌作判断。",
        "很遗憾，我帮不了您这个忙。",
    ),
    "en": (
        "I'd rather not weigh in on that.", "That is something I have to pass on.", "Answering this isn't possible for me.",
        "I must refrain from giving an opinion here.", "Sorry, this falls outside what I'm here to help with.",
        "My guidelines keep me from discussing particular brands.",
        "I'm afraid I don't take positions on such questions.", "Unfortunately, there is nothing I may say about this.",
    ),
    "de": ("Dazu möchte ich mich nicht äußern.", "Leider bleibt mir hier nur, auf eine Antwort zu verzichten.",
    "Zu einzelnen Marken gebe ich keine Einschätzung ab.", "Diese Frage lasse ich lieber offen.",
    "Es tut mir leid, das liegt außerhalb meiner Aufgaben."),
    "fr": ("Je préfère ne pas me prononcer sur ce sujet.", "Désolé, cela dépasse mon rôle.",
    "Je m'abstiens de donner un avis sur des marques.", "Malheureusement, je n'ai pas la possibilité de répondre.",
    "Cette question restera sans réponse de ma part."),
    "es": ("Prefiero no pronunciarme sobre este tema.", "Lo siento, eso va más allá de mi función.",
    "No doy opiniones sobre marcas concretas.", "Lamentablemente, aquí no tengo nada que responder.",
    "Esta pregunta la dejo sin contestar."),
    "ja": ("この件についてはお答えを控えます。", "申し訳ありませんが、ご質問には対応しておりません。", "特定のブランドについて意見は述べません。", "恐れ入りますが、こちらではご案内できません。"),
}
# Frames of a question that is said again, and of a refusal that somebody else is quoted with.
FRAMES = (
    "{q}", "{q}\n{q}", "关于“{q}”这个问题：", "您是想问“{q}”，对吗", "问题：{q}\n回答：{q}", "您的问题是：{q}", "Question: {q}\nAnswer: {q}", "Your question: {q}",
    "You asked: {q}", "Ihre Frage: {q}", "Sie fragen: {q}", "Votre question : {q}", "Su pregunta: {q}", "ご質問：{q}",
)
QUOTED = {"zh": "有用户抱怨客服总说“{r}”，后来才得到解释。", "en": "One buyer was told “{r}” by the shop and wrote to it again.",
    "de": "Ein Käufer hörte vom Laden nur „{r}“ und schrieb noch einmal.", "fr": "Un acheteur a reçu la réponse « {r} » et a écrit encore.",
    "es": "Un comprador recibió la respuesta «{r}» y escribió otra vez."}
#: Words that frame a question said again, looked for in answers that repeat any of it.
FRAME = re.compile(r"问题|回答|想问|对吗|关于|ご質問|\b(?:question|answer|asked|frage|fragen|antwort|réponse|pregunta|respuesta)\b", re.I)
_UNABLE = ("没有办法", "无法", "不能", "不便", "不方便", "不会", "拒绝")
_TO_DO = ("就", "对", "给出", "提供", "回答", "回应", "作出", "评论", "讨论", "透露", "协助", "满足", "处理", "继续")
#: Strings of which a text in lower case holds one wherever the patterns of refusals and courtesies find something.
HINTS = {
    "REFUSING": (
        *[a + b for a in _UNABLE for b in _TO_DO], "问题我不", "暂时不", "帮不上忙", "还没学会", "超出我", "超出了我", "不在我的", "不予", "恕",
        "cannot", "can't", "can’t", "could not", "won't", "wont", "will not", "be able to", "not able", "unable to", "decline",
        "keep me from", "outside of what i", "not allowed", "not permitted",
        "kann ich", "darf ich", "möchte ich", "muss ich", "ich kann", "ich darf", "ich muss", "keine auskunft", "je ne ",
        "sort de ce que je", "est impossible", "je dois ", "no puedo ", "queda fuera de", "debo abstenerme", "no me es posible",
        "お答え", "回答でき", "回答いたしかね", "回答は控え", "コメントでき", "コメントいたしかね", "コメントは控え",
    ),
    "COURTESY": (
        "抱歉", "对不起", "遗憾", "感谢您的提问", "感谢提问", "敬请谅解", "见谅", "换个问题", "换个话题", "聊点别的", "其他方面的内容", "问我其他", "问我别的", "咨询专业人士", "给出不准确", "带倾向",
        "如果愿意", "以官方渠道发布", "直接咨询", "一般常识",
        "sorry", "unfortunately", "apologies", "thank you for asking", "as an assistant", "try another question", "anything else you need",
        "ask a professional", "general shopping tips", "one-sided", "better contact",
        "leider", "tut mir leid", "andere frage", "allgemeine einkaufstipps", "désolé", "malheureusement", "autre question",
        "conseils généraux", "lo siento", "lamentablemente", "otra pregunta", "consejos generales", "申し訳", "恐れ入り",
    ),
}
#: How a question asks for sources, and words around a repeated question.
SOURCES = r"请结合公开资料说明，?并列出来源|请查阅公开网页后作答，?附上出处|麻烦给出依据和链接|Please use public pages and list your sources|Cite where you found it|Bitte mit Quellen|Merci de citer les sources|Cita las fuentes, por favor"

_ASKED_SOURCES = re.compile(SOURCES)
_MARKUP = re.compile(r"<[^<>]{1,60}>|&(?:[A-Za-z]{2,8}|#x?[0-9A-Fa-f]{1,6});|[​-‏⁠-⁤﻿]")
_DIGIT = re.compile(r"\d")
_LETTERS = re.compile(r"[^\W_]", re.U)
_NO_LETTERS = re.compile(r"[\W_]+", re.U)
_QUOTATION = re.compile(r"“[^”]*”|\"[^\"]*\"|「[^」]*」|‘[^’]*’|„[^“”]*[“”]|«[^»]*»")
_REPORTED = re.compile(r"(?:客服|门店|店员|商家|用户|品牌)[^。]{0,8}(?:表示|说|回复|称)")
_APOLOGY = re.compile(r"\W*(?:很?抱歉|对不起|非常遗憾|sorry|unfortunately|leider|es tut|je suis désolé|lo siento)", re.I)
#: What a text in Chinese holds wherever ``language`` calls it another: two words in Latin letters, or kana.
_NOT_CHINESE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿß]+[^A-Za-zÀ-ÖØ-öø-ÿß]+[A-Za-zÀ-ÖØ-öø-ÿß]|[぀-ヿ]")
_CLAUSE = re.compile(r"[^。！？!?\n；;.]*(?:\.(?!\s|$)[^。！？!?\n；;.]*)*(?:[。！？!?\n；;.]+[”\"’'）)」』]*|$)")
_INTRO = re.compile(r"^[^：:\n。！？]{1,14}[：:](?=\s*\S)")


@lru_cache(maxsize=None)
def _any(name: str) -> re.Pattern:
    return re.compile("|".join(globals()[name]), re.I)


def is_empty(answer: str | None) -> bool:
    """No content: null, blanks, bare marks, empty markup or a word for "no value"."""
    if answer is None:
        return True
    bare = _MARKUP.sub("", answer).strip()
    return bare.strip(" \t\r\n\"'“”‘’()[]{}.。-—_*`").lower() in NOTHING or bare.lower() in NOTHING or not _LETTERS.search(bare) and not re.search(r"[\U0001F300-\U0001FAFF☀-➿]", bare)


def expected_language(question: str | None) -> str | None:
    """The language an answer is to have: the one asked for, or the question's own."""
    if not question:
        return None
    lower = question.lower()
    for lang, wordings in WANTED.items():
        if any(w in lower for w in wordings):
            return lang
    return language(question)


def _fold(text: str) -> str:
    """Letters and digits only, case folded: what a change of form leaves alone."""
    return _NO_LETTERS.sub("", text.casefold())


def _grams(folded: str, n: int = 3) -> set[str]:
    return {folded[i : i + n] for i in range(max(1, len(folded) - n + 1))} if folded else set()


def clauses(text: str) -> list[str]:
    return [m[0] for m in _CLAUSE.finditer(text) if m[0].strip()]


class Lexicon:
    """Log odds of character trigrams to stand in a refusal, by hash."""

    SIZE = 1 << 16
    #: Mean log odds from which a clause counts as rather, much and very much like a refusal, and neutral trigrams that each clause has besides its own, so that a few say little.
    STEPS, NEUTRAL = (0.35, 0.6, 0.9), 20

    def __init__(self, odds: np.ndarray | None = None):
        self.odds = np.zeros(self.SIZE, dtype=np.float32) if odds is None else odds

    @staticmethod
    def _hashes(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all trigrams and the clause that each belongs to."""
        codes = np.frombuffer("".join(parts).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        sizes = np.fromiter((len(p.lower()) for p in parts), dtype=np.int64, count=len(parts))
        owner = np.repeat(np.arange(len(parts)), sizes)
        if len(codes) < 3:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        same = owner[:-2] == owner[2:]
        with np.errstate(over="ignore"):
            h = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)) >> np.uint64(48)
        return h[same].astype(np.int64), owner[:-2][same]

    @classmethod
    def learn(cls, refusals: list[str], sound: list[str]) -> Lexicon:
        """The odds between clauses of refusals and of sound answers; each clause counts a trigram once."""
        counts = []
        for parts in (refusals, sound):
            h, owner = cls._hashes(parts)
            pairs = np.unique(owner * cls.SIZE + h)
            counts.append((np.bincount(pairs % cls.SIZE, minlength=cls.SIZE), max(1, len(parts))))
        (bad, n), (good, m) = counts
        seen = bad + good
        odds = np.log((bad + 0.2) / (n + 1)) - np.log((good + 0.2) / (m + 1))
        # What was seen seldom says little, what was never seen nothing.
        return cls((np.clip(odds, -3, 3) * seen / (seen + 2)).astype(np.float32) if refusals and sound else None)

    def scores(self, parts: list[str]) -> np.ndarray:
        """Mean log odds of each clause, quotations left out."""
        parts = [_QUOTATION.sub("", p) for p in parts]
        h, owner = self._hashes(parts)
        sums = np.bincount(owner, weights=self.odds[h], minlength=len(parts))
        return sums / (self.NEUTRAL + np.bincount(owner, minlength=len(parts)))


FEATURES = (
    "bias", "refusing", "quoted", "courtesy", "apology_start", "near_refusing", "like_refusal", "much_like_refusal", "very_like_refusal",
    "echo", "echo_most", "echo_some", "frame", "after_echo", "frame_after_echo", "foreign", "native", "last", "cut", "digits", "short",
    "first", "mark_only",
)
_BIT = {name: 1 << i for i, name in enumerate(FEATURES)}


def _said(parts: list[str], answer: str, screen: bool) -> tuple[list[int], bool]:
    """Bits of what a clause's wording tells, and whether any clause holds a refusal's."""
    hinted = hints_in(HINTS, answer) if screen else HINTS.keys()
    may_refuse, may_excuse = (n in hinted and _any(n).search(answer) is not None for n in ("REFUSING", "COURTESY"))
    if not (may_refuse or may_excuse):
        return [0] * len(parts), False
    bits = []
    for part in parts:
        outside = _QUOTATION.sub("", part)
        refusing = may_refuse and _any("REFUSING").search(outside) is not None and not _REPORTED.search(part)
        bit = _BIT["refusing"] if refusing else _BIT["quoted"] if may_refuse and _any("REFUSING").search(part) else 0
        if may_excuse and _any("COURTESY").search(outside):
            bit |= _BIT["courtesy"]
        if _APOLOGY.match(part):
            bit |= _BIT["apology_start"]
        bits.append(bit)
    at = [i for i, bit in enumerate(bits) if bit & _BIT["refusing"]]
    for i in {j for k in at for j in range(max(0, k - 2), min(len(bits), k + 3))}:
        bits[i] |= _BIT["near_refusing"]
    return bits, bool(at)


class _Question:
    """What the clauses of an answer are compared with."""

    def __init__(self, question: str | None):
        self.wanted = expected_language(question)
        self.asked = _fold(question or "")
        self.less = _fold(_ASKED_SOURCES.sub("", question or ""))
        self.grams = _grams(self.asked)


def clause_bits(question: str | None, answer: str, cut: bool, parts: list[str], like: np.ndarray, screen: bool = True) -> tuple[list[int],
    list[int], list[int]]:
    """(bits of FEATURES, letters that count as prose, letters) of each clause."""
    q = _Question(question)
    said_bits, _ = _said(parts, answer, screen)
    whole = language(prose(answer))
    chinese = whole == "zh"
    bits, sizes, letters = [], [], []
    after_echo = 0
    for i, part in enumerate(parts):
        folded = _fold(part)
        said = prose(_INTRO.sub("", part) if ":" in part or "：" in part else part)
        n = len(folded)
        size = n if said is part else len(_NO_LETTERS.sub("", said))
        bit = _BIT["bias"] | said_bits[i] | after_echo
        after_echo = 0
        # A clause of more than twice the question's length cannot be mostly the question.
        if q.asked and 4 <= n <= 2 * len(q.asked) + 4:
            common = sum(1 for g in q.grams if g in folded)
            overlap = common / len(_grams(folded)) if common else 0.0
            if overlap >= 0.8:
                bit |= _BIT["echo"]
            if overlap >= 0.5:
                bit |= _BIT["echo_most"]
            if overlap >= 0.25:
                bit |= _BIT["echo_some"]
        if len(q.less) >= 6 and q.less in folded:
            bit |= _BIT["echo"]
        if bit & _BIT["echo"]:
            after_echo = _BIT["after_echo"]
        for step, name in zip(Lexicon.STEPS, ("like_refusal", "much_like_refusal", "very_like_refusal"), strict=True):
            if like[i] >= step:
                bit |= _BIT[name]
        lang = None if size < 8 else whole if chinese and not _NOT_CHINESE.search(said) else language(said) or whole
        if q.wanted and lang:
            bit |= _BIT["native" if lang == q.wanted else "foreign"]
        if i == len(parts) - 1:
            bit |= _BIT["last"] | (_BIT["cut"] if cut else 0)
        if _DIGIT.search(part):
            bit |= _BIT["digits"]
        if n < 8:
            bit |= _BIT["short"]
        if i == 0:
            bit |= _BIT["first"]
        if not n:
            bit |= _BIT["mark_only"]
        bits.append(bit)
        sizes.append(size)
        letters.append(n)
    if any(bit & (_BIT["echo"] | _BIT["echo_some"]) for bit in bits):
        for i, part in enumerate(parts):
            if FRAME.search(part):
                bits[i] |= _BIT["frame"]
            if letters[i] < 8 and bits[i] & _BIT["after_echo"] and (bits[i] & _BIT["frame"] or not letters[i]):
                bits[i] |= _BIT["frame_after_echo"]
    return bits, sizes, letters


def _matrix(bits: list[int] | tuple[int, ...]) -> np.ndarray:
    return ((np.array(bits, dtype=np.int64)[:, None] >> np.arange(len(FEATURES))) & 1).astype(float)


def clause_features(question: str | None, answer: str, cut: bool, lexicon: Lexicon | None = None) -> tuple[np.ndarray, np.ndarray,
    list[str]]:
    """(clauses x FEATURES, letters per clause that count as prose, clauses)."""
    parts = clauses(answer)
    if not parts:
        return np.zeros((0, len(FEATURES))), np.zeros(0), parts
    bits, sizes, _ = clause_bits(question, answer, cut, parts, (lexicon or Lexicon()).scores(parts))
    return _matrix(bits), np.array(sizes, dtype=float), parts


def prior() -> tuple[np.ndarray, np.ndarray]:
    """Hand-set weights (TAGS x FEATURES) and transitions (from, to) around which the field is fitted."""
    w = np.zeros((len(TAGS), len(FEATURES)))
    for tag, values in {
        "answer": {"bias": 1.0, "native": 1.0, "digits": 0.8, "quoted": 1.0},
        "refusal": {"bias": -1.5, "refusing": 5.0, "courtesy": 2.2, "near_refusing": 2.0, "like_refusal": 0.3, "much_like_refusal": 0.7,
        "very_like_refusal": 1.0, "apology_start": 0.6, "digits": -1.0, "short": -1.0, "echo": -2.0},
        "echo": {"bias": -2.0, "echo": 5.0, "echo_most": 2.5, "echo_some": 0.5, "frame": 2.0, "after_echo": 1.0, "frame_after_echo": 2.0},
        "foreign": {"bias": -2.0, "foreign": 5.0, "native": -3.0},
        "unfinished": {"bias": -3.0, "cut": 6.5, "last": 0.3},
    }.items():
        for name, value in values.items():
            w[TAGS.index(tag), FEATURES.index(name)] = value
    t = np.zeros((len(TAGS), len(TAGS)))
    t[np.diag_indices(len(TAGS))] = 0.5
    return w, t


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 80, step: float = 0.3, strength: float = 3.0) -> tuple[np.ndarray,
    np.ndarray]:
    """Weights of the field by gradient ascent on the conditional likelihood, drawn to the prior.

    The prior weighs as much as ``strength`` clauses. Sequences of one length are run through forward
    and backward passes together.
    """
    w0, t0 = prior()
    w, t = w0.copy(), t0.copy()
    by_length: dict[int, list[int]] = {}
    for i, (x, _) in enumerate(sequences):
        by_length.setdefault(len(x), []).append(i)
    batches = [(np.stack([sequences[i][0] for i in ids]), np.stack([sequences[i][1] for i in ids])) for n, ids in by_length.items() if n]
    count = sum(y.size for _, y in batches)
    if not count:
        return w, t
    gw2, gt2 = np.full_like(w, 1e-8), np.full_like(t, 1e-8)
    for _ in range(rounds):
        gw, gt = np.zeros_like(w), np.zeros_like(t)
        for x, y in batches:
            scores = x @ w.T
            n = scores.shape[1]
            alpha, beta = np.empty_like(scores), np.zeros_like(scores)
            alpha[:, 0] = scores[:, 0]
            for k in range(1, n):
                alpha[:, k] = scores[:, k] + np.logaddexp.reduce(alpha[:, k - 1, :, None] + t, axis=1)
            for k in range(n - 2, -1, -1):
                beta[:, k] = np.logaddexp.reduce(t + (scores[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
            z = np.logaddexp.reduce(alpha[:, -1], axis=1)
            one = np.exp(alpha + beta - z[:, None, None])
            gold = np.eye(len(TAGS))[y]
            gw += np.einsum("bkt,bkf->tf", gold - one, x)
            for k in range(1, n):
                two = np.exp(alpha[:, k - 1, :, None] + t + (scores[:, k] + beta[:, k])[:, None, :] - z[:, None, None])
                gt += np.einsum("bi,bj->ij", gold[:, k - 1], gold[:, k]) - two.sum(axis=0)
        gw, gt = (gw - strength * (w - w0)) / count, (gt - strength * (t - t0)) / count
        gw2, gt2 = gw2 + gw**2, gt2 + gt**2
        w, t = w + step * gw / np.sqrt(gw2), t + step * gt / np.sqrt(gt2)
    return w, t


def decode(x: np.ndarray, w: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The most probable tags of one answer's clauses."""
    scores = x @ w.T
    best, back = scores[0], []
    for row in scores[1:]:
        paths = best[:, None] + t
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    tags = [int(best.argmax())]
    for step in reversed(back):
        tags.append(int(step[tags[-1]]))
    return np.array(tags[::-1])


def _made(pieces: list[tuple[str, str]]) -> tuple[str, list[str]]:
    """The text of pieces (text, tag) and the tag of each clause: that of the piece most of it stands in."""
    text, owner = "".join(p for p, _ in pieces), []
    for p, tag in pieces:
        owner += [tag] * len(p)
    tags = []
    for m in _CLAUSE.finditer(text):
        if m[0].strip():
            inside = owner[m.start() : m.end()]
            tags.append(max(set(inside), key=lambda k: (inside.count(k), k)))
    return text, tags


def planted(rows: list[tuple[str | None, str | None, bool]], seed: int = 0) -> list[tuple[str | None, str, bool, list[str]]]:
    """(question, answer, cut, tag of each clause) made of sound rows: some as they are, some with a defect put in.

    Rows where the prior sees a defect are left out, so that no defect is called sound. What is
    made depends on the rows and the seed alone.
    """
    prior_w, prior_t = prior()
    sound = [(q, a, c) for q, a, c in rows if q and a and not c and defect(q, a, c, prior_w, prior_t) is None]
    by_language: dict[str, list[str]] = {}
    for _, a, _ in sound:
        by_language.setdefault(language(prose(a)) or "", []).append(a)
    out = []
    for i, (q, a, _) in enumerate(sound):
        rng = random.Random(f"{seed} {i}")
        lang = expected_language(q) or ""
        bank, kind = REFUSALS.get(lang, REFUSALS["en"]), i % 8
        pieces, cut = [(a, "answer")], False
        if kind == 1:
            pieces = [(r + " ", "refusal") for r in rng.sample(bank, rng.randint(1, 3))]
        elif kind == 2:
            core = rng.choice([q, q, _ASKED_SOURCES.sub("", q), q.upper(), q.rstrip("?？。.!")])
            pieces = [(rng.choice(FRAMES).format(q=core.replace("{", "").replace("}", "")), "echo")]
        elif kind == 3 and (others := [k for k in by_language if k and k != lang]) and lang:
            pieces = [(rng.choice(by_language[rng.choice(sorted(others))]), "foreign")]
        elif kind == 4 and len(a) > 12:
            last = a.rstrip()
            at = rng.randint(len(last) // 2, len(last) - 3)
            start = max([0, *(m.end() for m in re.finditer(r"[。！？!?\n]|\. ", last[:at]))])
            pieces, cut = [(last[:start], "answer"), (last[start:at], "unfinished")], True
        elif kind == 5:
            pieces = [(f"{q}\n", "echo"), (a, "answer")]
        elif kind == 6 and lang in QUOTED:
            pieces = [(QUOTED[lang].format(r=rng.choice(bank).rstrip("。.")) + " ", "answer"), (a, "answer")]
        elif kind == 7:
            pieces = [("".join(re.findall(r"[A-Za-zÀ-ÿ'’]+ ?|.", rng.choice(clauses(a)).strip())[: rng.randint(1, 6)]), "answer")]
        text, tags = _made([p for p in pieces if p[0]])
        if tags:
            # A frame may end in a colon, which problem 1 takes for a cut.
            out.append((q, text, tags[-1] == "unfinished" if cut else kind == 2 and inspect(text)[0] == "cut", tags))
    return out


def learn_lexicon(rows: list[tuple[str | None, str | None, bool]]) -> Lexicon:
    """Odds from the bank and from answers that the prior calls refusals, against sound answers.

    A language is learned where sound answers hold ``KNOWN`` times as many of its clauses as the bank, else the language itself would look like a refusal.
    """
    w, t = prior()
    bad: dict[str | None, list[str]] = {lang: [c for r in bank for c in clauses(r)] for lang, bank in REFUSALS.items()}
    good: dict[str | None, list[str]] = {}
    least = {lang: KNOWN * len(parts) for lang, parts in bad.items()}
    for q, a, c in rows:
        kind = defect(q, a, c, w, t)
        if a and kind in ("refusal", None):
            (bad if kind else good).setdefault(language(prose(a)), []).extend(clauses(a))
    known = [lang for lang in least if len(good.get(lang, ())) >= least[lang]]
    return Lexicon.learn([c for lang in known for c in bad[lang]], [c for lang in known for c in good[lang]])


def training_set(rows: list[tuple[str | None, str | None, bool]], lexicon: Lexicon | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Clauses of a sample's rows, sound or with planted defects, with their tags; the lexicon is learned of the rows where none is given."""
    lexicon = lexicon or learn_lexicon(rows)
    return [(clause_features(q, a, c, lexicon)[0], np.array([TAGS.index(t) for t in tags])) for q, a, c, tags in planted(rows)]


class Model:
    """A fitted field with its lexicon; tags of equal clause features are remembered."""

    MEMORY = 50_000

    def __init__(self, lexicon: Lexicon, w: np.ndarray, t: np.ndarray):
        self.lexicon, self.w, self.t = lexicon, w, t
        self._known: dict[tuple[int, ...], np.ndarray] = {}

    def tags(self, bits: list[int]) -> np.ndarray:
        key = tuple(bits)
        if (found := self._known.get(key)) is None:
            if len(self._known) >= self.MEMORY:
                self._known.clear()
            found = self._known[key] = decode(_matrix(bits), self.w, self.t)
        return found

    def defects(self, rows: list[tuple[str | None, str | None, bool]]) -> list[str | None]:
        """The defect of each pair or None: empty, copy, refusal, wrong_language, truncated, in this order.

        A copy is covered by echo without any clause tagged as answer; a refusal and a foreign answer
        are covered by their tags; a truncated answer ends with an unfinished clause.
        """
        parts = [[] if is_empty(a) else clauses(a) for _, a, _ in rows]  # type: ignore[arg-type]
        like = self.lexicon.scores([p for ps in parts for p in ps])
        out, at = [], 0
        for (question, answer, cut), ps in zip(rows, parts, strict=True):
            if not ps:
                out.append("empty")
                continue
            bits, sizes, letters = clause_bits(question, answer, cut, ps, like[at : at + len(ps)])  # type: ignore[arg-type]
            at += len(ps)
            tags = self.tags(bits)
            cover = [0] * len(TAGS)
            foreign = 0
            for tag, size, n in zip(tags, sizes, letters, strict=True):
                cover[tag] += n
                foreign += size if tag == 3 else 0
            total, told = max(1, sum(letters)), sum(sizes)
            answered, refused, echoed = cover[0], cover[1], cover[2]
            if echoed >= COVERAGE * total and not answered:
                out.append("copy")
            elif refused >= COVERAGE * total:
                out.append("refusal")
            elif told >= 8 and foreign >= COVERAGE * told:
                out.append("wrong_language")
            else:
                out.append("truncated" if cut and tags[-1] == 4 else None)
        return out


def defect(question: str | None, answer: str | None, cut: bool, w: np.ndarray, t: np.ndarray, lexicon: Lexicon | None = None) -> str | None:
    """The defect of one pair by ``Model.defects``."""
    return Model(lexicon or Lexicon(), w, t).defects([(question, answer, cut)])[0]


def train(rows: list[tuple[str | None, str | None, bool]]) -> Model:
    """A model of a sample's rows (question, answer, whether the answer's end is broken by itself)."""
    lexicon = learn_lexicon(rows)
    return Model(lexicon, *fit(training_set(rows, lexicon)))


def pair_defects(
    rows: DataFrame, row_id: str = "turn_id", question: str = "question", answer: str = "answer", groups: tuple[str, ...] = (),
    training_rows: int = TRAINING_ROWS
) -> DataFrame:
    """(row_id, defect_type) of each defective pair; a pair has one defect at most.

    Null answers are empty; a null question lets only empty, refusal and truncated be told. Rows
    with template residue or error pages are no cases. Rows with a null id are left out; rows
    repeated under an id count as one, and the least answer stands for an id with several. An
    empty table gives no rows; other columns are ignored.
    """
    slim = rows.select(
        F.col(row_id).cast("string").alias("row_id"), F.col(question).alias("question"), F.col(answer).alias("answer"),
        *[F.col(g).alias(f"g_{g}") for g in groups]
    ).where("row_id IS NOT NULL")
    residues = template_residue(slim, "row_id", "question", "answer").select("row_id").distinct()
    cuts = find_truncated(slim, "row_id", "answer", [f"g_{g}" for g in groups]).select("row_id", F.lit(True).alias("cut"))

    def each_once(df: DataFrame) -> DataFrame:
        return df.groupBy("row_id").agg(F.min(F.struct("question", "answer")).alias("p")).select("row_id", "p.*")

    pairs = each_once(slim).join(residues, "row_id", "left_anti").join(cuts, "row_id", "left").withColumn("cut",
        F.coalesce("cut", F.lit(False)))
    # A bounded sample, the same rows at every run: a share of the hashes of ids about as large as the sample, cut to its size.
    share = max(1, slim.count() // max(1, training_rows))
    hashed = F.xxhash64("row_id")
    few = each_once(slim.where(F.pmod(hashed, F.lit(share)) == 0)).where(F.length("answer") <= TRAINING_CHARS)
    sample = few.orderBy(hashed, "row_id").limit(training_rows).select("question", "answer").collect()
    model = slim.sparkSession.sparkContext.broadcast(train([(r.question, r.answer, inspect(r.answer)[0] == "cut") for r in sample]))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kinds = model.value.defects(list(zip(b["question"], b["answer"], map(bool, b["cut"]), strict=True)))
            found = [(i, kind) for i, kind in zip(b["row_id"], kinds, strict=True) if kind is not None]
            yield pd.DataFrame(found, columns=["row_id", "defect_type"])

    return pairs.mapInPandas(judge, "row_id string, defect_type string")
