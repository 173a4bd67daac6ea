"""Personal information inside free text (problem 9).

A text is normalised by transducers that keep, for every character of the result, the place it
came from: width and look-alike letters are folded, zero-width characters dropped, digits spelled
in Chinese or English written as digits, at/dot disguises of addresses undone. Identifiers are
detected in the normalised text and their spans mapped back to the source, where typed
placeholders can replace them and leave the rest of the text as it was.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.screens import hints_in, times_in

TYPES = ("email", "phone", "id_number", "address", "name")

# Look-alike letters, spelled digits, surnames, and the words around names and streets.
LOOKALIKES = dict(zip("АВЕКМНОРСТХУаеорсхуіјѕԁһΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXYaeopcxyijsdhABEZHIKMNOPTYXo", strict=True))
SPELLED = dict(zip("零〇一二三四五六七八九幺壹贰叁肆伍陆柒捌玖", "001234567891123456789", strict=True))
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9"}
SURNAMES = (
    "王李张刘陈杨黄赵周吴徐孙朱马胡郭林何高梁郑罗宋谢唐韩曹许邓萧冯曾程蔡彭潘袁于董余苏叶吕魏蒋田杜丁沈姜范江傅钟卢汪戴崔任陆廖姚方金邱夏谭韦贾邹石熊孟秦阎薛侯雷白龙段郝孔邵史毛常万顾赖武康贺严尹钱施牛洪龚"
    "汤陶黎温莫易樊乔文安殷颜庄章鲁倪庞邢俞翟蓝聂齐向申葛岳柏蒲祁郁骆阮裴蔺岑柳柯纪舒项祝梅盛童詹穆裘费卞华凌鲍花柴"
)
COMPOUND_SURNAMES = ("欧阳", "太史", "端木", "上官", "司马", "东方", "独孤", "南宫", "夏侯", "诸葛", "尉迟", "公羊", "赫连", "澹台", "皇甫", "宗政", "濮阳", "公冶", "太叔", "申屠",
    "公孙", "慕容", "仲孙", "钟离", "长孙", "宇文", "司徒", "鲜于", "司空", "闾丘", "令狐", "呼延", "百里", "东郭", "西门")
NAME_LEADS = (
    "my name is", "i am called", "reported by", "signed by", "a customer,", "customer", "contact:", "contact :", "contact name:", "name:",
    "attn:", "dear mr", "dear mrs", "dear ms", "dear miss", "dear dr",
    "mr", "mrs", "ms", "mr.", "mrs.", "ms.", "sehr geehrte frau", "sehr geehrter herr", "ich heiße", "mein name ist", "kontakt:",
    "ansprechpartner:", "frau", "herr",
    "chère madame", "cher monsieur", "madame", "monsieur", "je m'appelle", "je m’appelle", "mon nom est", "estimado señor",
    "estimada señora", "señor", "señora", "me llamo", "mi nombre es", "contacto:",
)
SIGN_OFFS = (
    "kind regards", "best regards", "warm regards", "regards", "yours sincerely", "sincerely", "yours faithfully", "best wishes",
    "mit freundlichen grüßen", "mit freundlichem gruß", "viele grüße", "beste grüße",
    "cordialement", "bien cordialement", "sincères salutations", "un saludo", "saludos", "saludos cordiales", "atentamente",
)
STREET_EN = "Street|St|Road|Rd|Lane|Ln|Drive|Dr|Close|Way|Avenue|Ave|Court|Ct|Place|Pl|Square|Terrace|Crescent|Boulevard|Blvd|Row|Mews|Hill|Gardens"
STREET_FR = "rue|avenue|av\\.|chemin|impasse|boulevard|bd|place|allée|quai|route|cours|passage|square|ruelle"
STREET_ES = "Calle|C/|Avenida|Avda\\.|Av\\.|Plaza|Paseo|Camino|Carretera|Carrera|Ronda|Travesía|Callejón"
STREET_DE = "straße|strasse|str\\.|weg|platz|gasse|allee|ring|damm|ufer|steig|pfad"

HAN = "一-鿿"
_CAP = r"[A-ZÀ-ÖØ-Þ](?:[a-zß-öø-ÿ]|['’](?=[A-Za-zÀ-ÿ]))+"
_GIVEN = rf"(?:{_CAP}|[A-ZÀ-Þ]{{2,}})(?:-(?:{_CAP}|[A-ZÀ-Þ]{{2,}}))?"
LATIN_NAME = rf"(?:{_GIVEN}, {_GIVEN}|(?:[A-ZÀ-Þ]\. ?){{1,2}}{_GIVEN}|{_GIVEN}(?: [A-ZÀ-Þ]\.)? {_GIVEN})(?![\w@])"
HAN_NAME = rf"(?:(?:{'|'.join(COMPOUND_SURNAMES)})[{HAN}]{{1,2}}|[{SURNAMES}][{HAN}]{{1,2}})"


def _any(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(w).replace("\\ ", r"[ \u00a0]") for w in sorted(words, key=len, reverse=True))


@lru_cache(maxsize=1)
def _specs() -> list[tuple[str, str, str]]:
    """(type, what a text must hold for the pattern to find anything, pattern), in order of precedence; group 1 is the span where there is one.

    Needs are "@", "number" (six digits near each other), "zh" (a numeral before 号) or a key of ``RAW_HINTS`` or ``HINTS``.
    """
    end = r"(?![\d])"
    out: list[tuple[str, str, str]] = [
        ("email", "@",
        r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9](?:[A-Za-z0-9_.+-]{0,62}[A-Za-z0-9_])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9_-])"),
        # identity numbers: China, passport, SSN or ITIN, NINO, DNI and NIE, NIR, Steuer-ID, My Number
        ("id_number", "number",
        r"(?<![A-Za-z0-9_.-])\d{6}([ -]?)(?:18|19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\1\d{3}[\dXx](?![A-Za-z0-9_])"),
        ("id_number", "number", r"(?<![A-Za-z\d])[EGDSPH][ ]?\d{4}[ ]?\d{4}(?!\d)"),
        ("id_number", "number", r"(?<![\d./:-])\d{3}([- ])\d{2}\1\d{4}(?![\d/:-])"),
        ("id_number", "number", r"(?<![A-Za-z\d])[A-CEGHJ-PQR-TW-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D](?![A-Za-z\d])"),
        ("id_number", "number", r"(?<![A-Za-z0-9_.-])(?:\d{8}|\d{2}\.\d{3}\.\d{3})[- ]?[A-HJ-NP-TV-Z](?![A-Za-z0-9_])"),
        ("id_number", "number", r"(?<![A-Za-z0-9_])[XYZ][- ]?\d{7}[- ]?[A-HJ-NP-TV-Z](?![A-Za-z0-9_])"),
        ("id_number", "number", r"(?<![\d.,-])[1-4] \d{2} \d{2} \d[\dAB] \d{3} \d{3}(?: \d{2})?(?![\d])"),
        ("id_number", "number", r"(?i:sécurité sociale|sécu|\bNIR\b|INSEE)[^\d\n]{0,30}([12]\d{12}(?:\d{2})?)" + end),
        ("id_number", "number", r"(?i:steuer)[^\d\n]{0,40}(\d{2} ?\d{3} ?\d{3} ?\d{3})" + end),
        ("id_number", "number", r"(?<![\d.,+-])\d{2} \d{3} \d{3} \d{3}(?![ ]?\d)"),
        ("id_number", "number", r"(?:マイナンバー|個人番号)[^\d\n]{0,12}(\d{4}[ -]?\d{4}[ -]?\d{4})" + end),
        ("id_number", "number",
        r"(?i:身份证|证件|护照|passport|\bSSN\b|social security|tax id)[^\d\n]{0,14}?([A-Z]{0,2}\d{7,18}[A-Za-z]?)(?![\dA-Za-z])"),
        # telephone numbers
        ("phone", "number", r"(?<![A-Za-z0-9_.+-])\(?(?:\+|00)86\)?[ -]?1[3-9]\d[ -]?\d{4}[ -]?\d{4}" + end),
        ("phone", "number", r"(?<![A-Za-z0-9_.+/:-])1[3-9]\d([ -]?)\d{4}\1\d{4}(?![A-Za-z0-9_/:-]|\.\d)(?! ?[次件条份元人])"),
        ("phone", "number",
        r"(?<![A-Za-z0-9_.+/:-])(?:\(0\d{2,3}\) ?|0\d{2,3}[- ])[2-9]\d{2,3}[ -]?\d{4}(?:[ ]?(?:转|ext\.?|x)[ ]?\d{1,5})?" + end),
        ("phone", "number",
        r"(?<![A-Za-z0-9_.+/:-])(?:\+?1[-. ])?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?:,? ?(?:ext\.?|x|extension) ?\d{1,5})?(?![\d/:-])"),
        ("phone", "number",
        r"(?<![A-Za-z0-9_.+/:-])\(?(?:\+|00)(?:1|[2-9]\d{1,2})\)?[ .-]?(?:\(0\)[ .-]?)?\d(?:[ ./-]?\d){7,11}(?:,? ?(?:ext\.?|x|转) ?\d{1,5})?" + end),
        ("phone", "number", r"(?<![A-Za-z0-9_.+/:-])0[1-9](?:([ .-])\d{2}\1\d{2}\1\d{2}\1\d{2}|\d{8})(?![A-Za-z0-9_/:-]|\.\d)"),
        ("phone", "number", r"(?<![A-Za-z0-9_.+/:-])0\d{2,4}(?:[ /-]\d{3,8}){1,2}(?:[ -]\d{2,5})?(?![A-Za-z0-9_/:]|[.-]\d)"),
        ("phone", "number", r"(?<![A-Za-z0-9_.+/:-])[5-9]\d{2}([ -])(?:\d{3}\1\d{3}|\d{2}\1\d{2}\1\d{2})(?![\d/:]|[.,-]\d)"),
        ("phone", "number",
        r"(?:電話|电话|☎|(?i:\b(?:tel|phone|mobile|telefon|teléfono|téléphone)\b))[^\d\n+(]{0,12}(\(?\+?\d[\d ().-]{6,18}\d)" + end),
        # addresses with a house number
        ("address", "zh",
        rf"(?:(?![在到至是于住寄送址])[{HAN}]){{1,16}}?(?:路|街|巷|大道|弄|胡同|道)[一二三四五六七八九十百\d]+号(?:院)?(?:\d+号楼|\d+[栋幢座楼])?(?:\d+单元)?(?:\d+[室号]?)?"),
        ("address", "zh", rf"(?:(?![在到至是于住寄送址])[{HAN}]){{1,14}}[村屯寨庄][一二三四五六七八九十\d]+[组队社]\d+号"),
        ("address", "ja", rf"[{HAN}ァ-ヶ]{{2,16}}\d+丁目\d+(?:番|-)\d+(?:号|-\d+)?"),
        ("address", "en",
        rf"(?<![\w.,])(?:(?:Flat|Apt|Unit|Suite)\.? \d+[A-Za-z]?, )?\d{{1,5}}[A-Za-z]? (?:[A-Z][\w'’]+ ){{1,3}}(?:{STREET_EN})(?![\w])\.?(?:,? (?:Flat|Apt|Unit|Suite)\.? \d+[A-Za-z]?)?(?:, [A-Z][\w'’]+(?: [A-Z][\w'’]+)?)?"),
        ("address", "de",
        rf"(?<!\w)(?:[A-ZÄÖÜ][\wäöüß-]*(?:{STREET_DE})|(?:[A-ZÄÖÜ][\wäöüß-]+ ){{1,2}}(?:Str\.|Straße|Platz|Weg|Allee|[A-ZÄÖÜ][\wäöüß]*platz)|(?:Am|An der|Auf dem|Im|Zum|Zur) (?!Jahr\b)[A-ZÄÖÜ][\wäöüß-]+) \d{{1,3}} ?[a-z]?(?![\w%]|[.,]\d)(?:, \d{{5}} [A-ZÄÖÜ][\wäöüß-]+)?(?! (?:Prozent|Euro|Tage|Wochen|Befragte|Proben|Quellen))"),
        ("address", "fr",
        rf"(?<![\w.,])\d{{1,4}}(?: ?(?:bis|ter|quater))?,? (?i:{STREET_FR}) [\w'’ À-ÿ-]{{2,40}}?(?=[.,;\n\r]|$)(?:, \d{{5}} [A-ZÀ-Þ][\w'’ À-ÿ-]+)?"),
        ("address", "es",
        rf"(?<!\w)(?:{STREET_ES}) ?(?:(?:de|del|la|las|los|el) ){{0,3}}[A-ZÁ-Ú][\wÀ-ÿ]+(?: (?:de |del |la |las |los )?[A-ZÁ-Ú][\wÀ-ÿ]+){{0,3}},? (?:n\.?º ?)?\d{{1,4}}(?!\d)(?:, \d{{1,2}}\.?º ?[A-Z]?)?"),
        # names of persons
        ("name", "han",
        rf"(?:我叫|我是|本人|姓名(?:是|为|[:：])?|联系人(?:是|为|[:：])?|收件人(?:是|为|[:：])?|收货人(?:是|[:：])?|寄件人(?:是|[:：])?|抄送人(?:是|为|[:：])?|顾客|客户|用户|尊敬的|签名[:：])[ ]?({HAN_NAME})(?=[，。；、,.;!！\s]|先生|女士|小姐|反映|表示|来电|投诉|电话|$)"),
        ("name", "title", rf"(?<![{HAN}])({HAN_NAME})(?=先生|女士|小姐)"),
        ("name", "han_off", rf"(?:此致|敬礼|敬上|谨上|祝好|顺颂商祺)[，,。!！]?\s+({HAN_NAME})(?=\s|$)"),
        ("name", "lead", rf"(?<![\w])(?i:{_any(NAME_LEADS)})[ ]+({LATIN_NAME})"),
        ("name", "off", rf"(?<![\w])(?i:{_any(SIGN_OFFS)})[,.!]?\s+({LATIN_NAME})(?=\s|$)"),
    ]
    return out


@lru_cache(maxsize=1)
def _needs() -> list[tuple[str, re.Pattern, str]]:
    return [(kind, re.compile(pattern, re.M), need) for kind, need, pattern in _specs()]


def _patterns() -> list[tuple[str, re.Pattern]]:
    """(type, pattern), in order of precedence."""
    return [(kind, pattern) for kind, pattern, _ in _needs()]


#: Six digits; a labelled number's 9 digits within 20 characters leave up to 11 between two of them.
_NUMBER = re.compile(r"\d(?:[ .()/+-]{0,11}\d){5}")
_ANY_DIGIT = re.compile(r"\d")
_ZH_NUMBER = re.compile(r"[一二三四五六七八九十百\d]号")
_plain = lambda names: tuple(w.replace("\\", "") for w in names.split("|"))
#: Strings of which a text holds one wherever a pattern of that need finds something, in the text as it is.
RAW_HINTS = {
    "ja": ("丁目",), "en": tuple(f" {w}" for w in STREET_EN.split("|")), "es": _plain(STREET_ES),
    "de": ("straße", "strasse", "tr.", "weg", "Weg", "latz", "gasse", "llee", "ring", "damm", "ufer", "steig", "pfad", "Am ", "An der",
    "Auf dem", "Im ", "Zum ", "Zur ", "Straße"),
    "han": ("我叫", "我是", "本人", "姓名", "联系人", "收件人", "收货人", "寄件人", "抄送人", "顾客", "客户", "用户", "尊敬的", "签名"),
    "title": ("先生", "女士", "小姐"), "han_off": ("此致", "敬礼", "敬上", "谨上", "祝好", "顺颂商祺"),
}
#: The same in lower case, with usual blanks.
HINTS = {"fr": _plain(STREET_FR), "lead": NAME_LEADS, "off": SIGN_OFFS}
_DIGITED = ("ja", "en", "es", "de", "fr")


def _screened(text: str) -> list[tuple[str, re.Pattern]]:
    """The patterns that can find anything in a text, by strings and one scan that each of them needs."""
    held = hints_in(RAW_HINTS, text, lower=False) | hints_in(HINTS, text)
    if _NUMBER.search(text):
        held.add("number")
    elif not _ANY_DIGIT.search(text):
        held.difference_update(_DIGITED)
    if "@" in text:
        held.add("@")
    if "号" in text and _ZH_NUMBER.search(text):
        held.add("zh")
    return [(kind, pattern) for kind, pattern, need in _needs() if need in held]


#: What stands before numbers that identify things, not persons.
_THING = re.compile(r"(?i:订单号?|单号|批号|条码|备案号|编号|观看量|注文番号|ロット|バーコード|\border\b|\bbarcode\b|\bbatch\b(?: no\.?)?|\bsection\b|\bbestellnummer\b|\bcharge\b|\bcommande\b|\blot\b|\bpedido\b|\blote\b|\bversion\b|\bisbn\b|\bsku\b)[ :：#]{0,3}$")
_LINK = re.compile(r"(?i:https?://|www\.)[^\s<>\"'，。；、）】]+")
_ZERO_WIDTH = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]")
_AT = re.compile(
    r"(?<![A-Za-z0-9_.+-])([A-Za-z0-9][A-Za-z0-9_.+-]{0,63})(\s?[\[({]\s?(?:at|@)\s?[\])}]\s?|[ ]?@[ ]?|[ ]at[ ])"
    r"((?:[A-Za-z0-9-]+(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|[ ]dot[ ]|\.))+[A-Za-z]{2,24})(?![A-Za-z0-9_-])",
    re.I,
)
_AT_WORD = re.compile(r"(?:[\[({ ]at[\])} ])[^\n]{0,60}(?:\bdot\b|\.)", re.I)
_DOT = re.compile(r"\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|[ ]dot[ ]", re.I)
_SPELLED = re.compile(f"[{''.join(SPELLED)}](?:[ -]?[{''.join(SPELLED)}]){{6,17}}")
_WORDS = re.compile(rf"\b(?:{'|'.join(DIGIT_WORDS)})(?:[ ,-]+(?:{'|'.join(DIGIT_WORDS)})){{6,17}}\b", re.I)
_LOOKALIKE = re.compile(f"[{''.join(LOOKALIKES)}]")
_MIXED = re.compile(rf"[A-Za-z0-9@._+-]*[{''.join(LOOKALIKES)}][A-Za-z0-9@._+{''.join(LOOKALIKES)}-]*")


@lru_cache(maxsize=1)
def _width() -> dict[int, int]:
    """Code points of another width to their usual form, one to one."""
    wide = [*range(0xFF01, 0xFF5F), *range(0x2460, 0x2469), 0x3000, *range(0x1D7CE, 0x1D800)]
    return {c: ord(n) for c in wide if len(n := unicodedata.normalize("NFKC", chr(c))) == 1 and chr(c) not in "，。：；！？（）"} | {0xA0: 0x20,
        0x2010: 0x2D, 0x2011: 0x2D, 0x2012: 0x2D, 0x2013: 0x2D, 0x2212: 0x2D, 0xFE6B: 0x40, 0xFF08: 0x28, 0xFF09: 0x29}


@lru_cache(maxsize=1)
def _wide() -> re.Pattern:
    return re.compile("[" + "".join(re.escape(chr(c)) for c in _width()) + "]")


class Normalised:
    """A text and, where it was rewritten, the source place of each character."""

    def __init__(self, source: str):
        self.source = source
        self.places: list[int] | None = None
        self.text = source if source.isascii() else _wide().sub(lambda m: chr(_width()[ord(m[0])]), source)  # one to one: places stay
        if _ZERO_WIDTH.search(self.text):
            self._rewrite(_ZERO_WIDTH, lambda m: [])
        if not source.isascii():
            if _LOOKALIKE.search(self.text):
                self._same_length(_MIXED, self._latin)
            self._same_length(_SPELLED, lambda s: "".join(SPELLED.get(c, c) for c in s))
        if times_in(DIGIT_WORDS, self.text) >= 7 and _WORDS.search(self.text):
            self._rewrite(_WORDS, lambda m: [(DIGIT_WORDS[w[0].lower()], w.start()) for w in re.finditer("[A-Za-z]+", m[0])])
        if "@" in self.text or _AT_WORD.search(self.text):
            self._rewrite(_AT, self._address)

    @staticmethod
    def _latin(word: str) -> str:
        return "".join(LOOKALIKES.get(c, c) for c in word) if re.search("[A-Za-z0-9@]", word) else word

    @staticmethod
    def _address(m: re.Match) -> list[tuple[str, int]]:
        """The characters of an address without its disguise, with their places in the match."""
        out = [(c, i) for i, c in enumerate(m[1])]
        out.append(("@", m.start(2) - m.start()))
        base, at = m.start(3) - m.start(), 0
        for d in _DOT.finditer(m[3]):
            out += [(m[3][i], base + i) for i in range(at, d.start())] + [(".", base + d.start())]
            at = d.end()
        return out + [(m[3][i], base + i) for i in range(at, len(m[3]))]

    def _same_length(self, pattern: re.Pattern, change) -> None:
        self.text = pattern.sub(lambda m: change(m[0]), self.text)

    def _rewrite(self, pattern: re.Pattern, change) -> None:
        old = self.places if self.places is not None else range(len(self.text))
        parts, places, at = [], [], 0
        for m in pattern.finditer(self.text):
            parts.append(self.text[at : m.start()])
            places.extend(old[at : m.start()])
            for c, i in change(m):
                parts.append(c)
                places.append(old[m.start() + i])
            at = m.end()
        parts.append(self.text[at:])
        places.extend(old[at:])
        self.text, self.places = "".join(parts), places

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The source span of [start, end)."""
        if self.places is None:
            return start, end
        return self.places[start], self.places[end - 1] + 1


def find_pii(text: str | None) -> list[tuple[str, int, int]]:
    """(type, start, end) in code points of the source, in order, without overlaps."""
    if not text or not text.strip():
        return []
    n = Normalised(text)
    taken: list[tuple[int, int]] = [m.span() for m in _LINK.finditer(n.text)] if "://" in n.text or "www." in n.text.lower() else []
    found: list[tuple[str, int, int]] = []
    for kind, pattern in _screened(n.text):
        for m in pattern.finditer(n.text):
            grouped = pattern.groups and kind in ("name", "id_number", "phone") and m.lastindex and len(m[m.lastindex]) > 1
            start, end = m.span(m.lastindex) if grouped else m.span()
            if kind in ("phone", "id_number"):
                if _THING.search(n.text[max(0, start - 24) : start]):
                    continue
                digits = sum(c.isdigit() for c in n.text[start:end])
                if kind == "phone" and not 9 <= digits <= 18:
                    continue
            if any(a < end and start < b for a, b in taken):
                continue
            taken.append((start, end))
            found.append((kind, *n.span(start, end)))
    return sorted(found, key=lambda f: f[1])


def lines_of(text: str, places: list[int]) -> list[int]:
    """The line of each place; lines end at line feeds only and count from 1."""
    feeds = [i for i, c in enumerate(text) if c == "\n"] if places else []
    return [bisect_right(feeds, p - 1) + 1 for p in places]


def redact_text(text: str | None) -> str | None:
    """The text with ``[EMAIL]``, ``[PHONE]``, ``[ID_NUMBER]``, ``[ADDRESS]`` and ``[NAME]`` in place of what was found."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in find_pii(text):
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


def pii_spans(text: str | Column) -> Column:
    """array<struct<pii_type, line_no, start, end>>: start counts code points from 0, end is exclusive.

    Null, empty and blank texts give an empty array; texts of any length are read whole.
    """

    @F.pandas_udf("array<struct<pii_type:string,line_no:int,start:int,end:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = []
            for t in batch:
                found = find_pii(t)
                lines = lines_of(t, [f[1] for f in found]) if found else []
                rows.append([{"pii_type": k, "line_no": n, "start": a, "end": b} for (k, a, b), n in zip(found, lines, strict=True)])
            yield pd.Series(rows)

    return spans(F.col(text) if isinstance(text, str) else text)


def redact(text: str | Column) -> Column:
    """The text with typed placeholders; null stays null, other texts keep every other character."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(redact_text, na_action="ignore")

    return clean(F.col(text) if isinstance(text, str) else text)


def find_in(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, pii_type, start, end), one row per finding; an empty table gives none."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.inline(pii_spans(text)))
    return rows.select("doc_id", "line_no", "pii_type", "start", "end")
