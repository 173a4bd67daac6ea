"""Template residue and error-page text (problem 5).

Slots are induced by aligning records of one template: the text right before and after a
placeholder is looked up in all records. Where another record holds ordinary text at that place,
the placeholder stands in an unfilled slot; where several records hold placeholders there, the
template is broken in all of them. A placeholder that aligns with no other record is text.

Notices (error pages, service notices, demands for scripts) and filler are lines whose template,
the words without numbers and ids, repeats over records. Wording is one feature of such a line
beside repetition and standing apart from other text; ``notice_score`` adds them up. Where the
question asks about such things, only templates that repeat under other questions count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from citeloom.llm.bloom import filter_of, may_hold, mixed
from citeloom.llm.language import is_pseudo_latin
from citeloom.llm.screens import hints_in
from citeloom.session import cut_lineage

#: Characters of context on each side that records are aligned by.
CONTEXT = 6
#: Contexts that the broadcast filter is sized for (16 MB); with more of them it grows no further and lets more pass.
BROADCAST_CONTEXTS = 4_000_000
#: Ordinary fillings that make a slot with the placeholder itself, those where the reader is told to write it, and records that make a template.
FILLINGS, TOLD_FILLINGS, PAGES = 1, 2, 3
#: What wording, weak wording, a line of its own and a repeated template add to a notice's score, and the score of a notice.
STRONG, WEAKLY, APART, REPEATED, NOTICE = 2.0, 0.5, 1.0, 1.5, 3.0
#: Characters whose windows are looked up at once, and contexts that a task holds before it hands them on.
PART_CHARS, HELD = 400_000, 100_000

# Placeholder syntaxes.
_NAME = r"[A-Za-z_一-鿿][\w.一-鿿-]*"
PLACEHOLDERS = (
    rf"\{{\{{\s*(?:{_NAME})\s*\}}\}}", rf"\$\{{\s*{_NAME}\s*\}}", rf"<%=?\s*{_NAME}\s*%>",
    rf"\{{%\s*(?:if |for )?{_NAME}[^%\n]{{0,30}}%\}}",
    rf"\[\[\s*{_NAME}\s*\]\]", rf"\{{{_NAME}\}}", r"\{\d\}", rf"%{_NAME}%", rf"#{_NAME}#", rf"__{_NAME}?[^\W_]__", rf"@@{_NAME}@@",
    rf"\$[A-Z][A-Z0-9_]+\$",
    rf"<(?!/?(?:br|p|b|i|a|u|div|span|h[1-6]|html|head|body|title|ul|ol|li|table|tr|td|th|em|strong|hr|img|code|pre|sub|sup|noscript|script|style|meta|link|center|font|small|blockquote)\b){_NAME}>",
    r"\[(?:INSERT|Insert|YOUR|Your|ENTER|Enter|ADD|Add) [^\]\n]{1,40}\]", r"【(?:请填写|请输入|填写|插入|待填)[^】\n]{0,30}】",
    r"（(?:此处插入|此处填写|请填写|待填写)[^）\n]{0,30}）",
    r"_{4,}",
)
# Words right before a placeholder that tell the reader to write it.
TOLD = re.compile(r"(?:\b(?:put|type|write|insert|schreibe?n? Sie|tippe?n? Sie|écrivez|tapez|escriba|escribe)|写成|写作|写上|写为|填写|填入|输入|插入)[ :：]*[\"'“‘「『]?$", re.I)
# Filler.
FILLER = (
    r"lorem ipsum", r"\bdolor sit amet\b", r"\bdummy (?:copy|text)\b", r"\byour (?:text|content|copy) goes here\b",
    r"\bplaceholder (?:answer|text|copy|content)\b", r"\bbody copy to follow\b", r"^\W*(?:TBD\W*){1,}$", r"\bTBD(?:\W+TBD)+\b",
    r"\bTODO\b ?[:：]", r"\bFIXME\b", r"^\W*x{2,}(?:\W+x{2,}){2,}\W*$", r"\btext to be replaced\b", r"\breplace this (?:paragraph|text)\b",
    r"\bdo not ship\b",
    r"占位(?:文案|文字|文本|内容)", r"(?:示例|样例)(?:文字|文案|文本).{0,12}替换", r"待补充(?:待补充)+", r"待补充。?$", r"(?:测试){3,}", r"X{3,4}公司", r"X{3,}元", r"此处为示例",
    r"內容待補|内容待定",
    r"\bBlindtext\b", r"\bPlatzhaltertext\b", r"\btexte? (?:factice|de remplissage)\b", r"\btexto de (?:relleno|ejemplo)\b", r"ダミーテキスト",
)
# Demands for scripts.
SCRIPT = (
    r"(?:enable|turn on|activate|allow|requires?|needs?|switch on|without|disabled?|support)\W+(?:\w+\W+){0,4}?(?:javascript|scripts?|scripting|cookies)\b", r"\b(?:javascript|scripts?|scripting|cookies)\b\W+(?:\w+\W+){0,4}?(?:required?|disabled|enabled?|turned off|needed|switched off|blocked)",
    r"<noscript>", r"(?:启用|开启|打开|允许|支持|需要|使用|禁用|关闭|未开启|未启用)[^。，\n]{0,6}(?:JavaScript|脚本|Cookie)",
    r"(?:JavaScript|脚本|Cookie)[^。，\n]{0,8}(?:被禁用|未开启|未启用|关闭|功能)",
    r"(?:aktivieren|einschalten|erlauben)\W+(?:\w+\W+){0,3}?(?:javascript|skripte|cookies)|javascript[^.\n]{0,20}(?:aktivier|deaktivier|erforderlich)",
    r"(?:activez|activer|autoris)\w*\W+(?:\w+\W+){0,3}?(?:javascript|scripts|cookies)|javascript[^.\n]{0,20}(?:désactivé|requis|nécessaire)", r"(?:active|activa|activar|habilite|habilitar|permita)\W+(?:\w+\W+){0,3}?(?:javascript|scripts|cookies)|javascript[^.\n]{0,20}(?:desactivado|necesario)", r"JavaScript[^。\n]{0,6}(?:無効|有効|必要)",
)
# Error pages and service notices.
ERROR = (
    r"\bHTTP(?: Error|/\d(?:\.\d)?)? ?[1-5]\d\d\b",
    r"\b[45]\d\d\b[ :\-–—]*(?:Not Found|Forbidden|Bad Gateway|Bad Request|Service (?:Temporarily )?Unavailable|Gateway Time-?out|Internal Server Error|Too Many Requests|Unauthorized|Request Timeout|Gone)\b", r"<title>[^<]{0,60}</title>", r"<h1>[^<]{0,60}</h1>",
    r"\bupstream (?:connect error|request timeout)", r"\borigin unreachable\b", r"\bTraceback \(most recent call last\)",
    r"^\s*(?:Key|Value|Type|Attribute|Index|Runtime|Name)Error: ", r"\bException in thread\b",
    r"\"(?:code|status|error_code)\"\s*:\s*\"?[45]\d\d", r"\b(?:connection|request) (?:timed out|reset by peer|refused)\b",
    r"\bERR_[A-Z_]{4,}\b",
    r"\bsession (?:has )?(?:expired|timed out)", r"\blog in again\b", r"\bsomething went wrong\b",
    r"\bchecking (?:that|if) you are (?:a )?human\b|\bverify (?:that )?you are (?:a )?human\b", r"\bunusual traffic\b",
    r"\brate limit (?:exceeded|reached)\b",
    r"\b(?:daily|free|monthly) (?:quota|limit)\W+(?:\w+\W+){0,4}?(?:reached|exceeded|used up|exhausted)", r"\btoo many requests\b",
    r"\b(?:service|server|site|page) (?:is )?(?:temporarily |currently )?(?:unavailable|down for maintenance|under maintenance)\b",
    r"\bpage (?:you requested |you are looking for )?(?:could not be|was not|cannot be) found\b", r"\baccess denied\b",
    r"\b(?:access|request)\b[^.\n]{0,30}\b(?:was|is|has been) (?:blocked|denied|refused)\b",
    r"\btry again in (?:a few|\d+) (?:minutes|seconds)\b",
    r"页面(?:走丢|不存在|找不到|无法访问|出错|已删除)", r"(?:内容|页面|资源|文章)[^。\n]{0,6}(?:不存在|已下线|已删除)[^。\n]{0,4}(?:下线|删除|[（(][45]\d\d[)）])",
    r"系统(?:开小差|繁忙|异常|错误|维护)", r"刷新重试|点击重新加载|重新加载页面|请稍后(?:再试|重试)", r"(?:服务|服务器|网络)(?:繁忙|异常|错误|开小差|连接超时|超时|不可用)", r"排队，请|人排队",
    r"(?:免费|今日|本月)[^。\n]{0,4}(?:额度|次数)[^。\n]{0,6}(?:用完|用尽|达到?上限)", r"登录(?:状态)?[^。\n]{0,4}(?:失效|过期)", r"请(?:先|重新)?登录后",
    r"访问(?:异常|受限|过于频繁|被拒绝)", r"滑动(?:拼图|验证|滑块)|完成(?:安全)?验证|验证码错误", r"正在(?:升级|维护)中?",
    r"\b(?:Seite|Dienst)[^.\n]{0,20}(?:nicht gefunden|nicht verfügbar|nicht erreichbar)", r"\bSitzung (?:ist )?abgelaufen\b",
    r"\bpage (?:introuvable|non trouvée)\b", r"\bsession (?:a )?expiré", r"\bservice (?:temporairement )?indisponible\b",
    r"\bpágina no encontrada\b", r"\bla sesión ha caducado\b", r"\bservicio no disponible\b",
    r"ページが見つかりません|セッション(?:が|の)(?:切れ|期限)|しばらくしてから(?:再度|もう一度)",
)
# Weaker wording.
WEAK = (r"\berror\b", r"\bgateway\b", r"\bproxy\b", r"\bunavailable\b", r"\bretry\b", r"\breload\b", r"错误|异常|重试|刷新|加载失败|请求失败",)
#: Strings of which a text in lower case holds one wherever the patterns find something; they spare most texts the patterns.
HINTS = {
    "FILLER": (
        "lorem ipsum", "dolor sit", "dummy copy", "dummy text", "goes here", "placeholder answer", "placeholder text", "placeholder copy",
        "placeholder content", "body copy", "tbd", "todo:", "todo：", "todo :", "todo ：", "fixme", "xx", "to be replaced", "replace this",
        "do not ship", "占位", "示例文", "样例文", "待补充", "待补。", "测试测试测试", "此处为示例", "內容待補", "内容待定", "blindtext", "platzhaltertext", "factice",
        "remplissage",
        "relleno", "de ejemplo", "ダミーテキスト",
    ),
    "SCRIPT": (
        "script", "skript", "cookie", "脚本",
    ),
    "ERROR": (
        "http/", "http error", "http 1", "http 2", "http 3", "http 4", "http 5", "http1", "http2", "http3", "http4", "http5", "not found",
        "forbidden", "bad gateway", "bad request", "unavailable", "gateway time", "internal server", "too many requests", "unauthorized",
        "request timeout", "gone", "<title", "<h1", "upstream connect", "upstream request", "unreachable", "traceback (", "error: ",
        "exception in thread", "\"code\"", "\"status\"", "\"error_code\"", "timed out", "reset by peer", "refused", "err_", "expired",
        "log in again", "went wrong", "human", "unusual traffic", "rate limit", "reached", "exceeded", "used up", "exhausted",
        "maintenance",
        "be found", "denied", "blocked", "try again in", "走丢", "不存在", "找不到", "无法访问", "出错", "已删除", "已下线", "开小差", "繁忙", "异常", "错误", "系统维护",
        "刷新重试",
        "重新加载", "请稍后", "超时", "不可用", "排队", "用完", "用尽", "上限", "登录", "受限", "频繁", "被拒绝", "滑动", "完成验证", "完成安全验证", "正在升级", "正在维护",
        "nicht gefunden", "nicht verfügbar", "nicht erreichbar", "abgelaufen", "introuvable", "trouvée", "expiré", "indisponible",
        "no encontrada",
        "ha caducado", "no disponible", "ページが見つ", "セッション", "しばらくして",
    ),
    "WEAK": (
        "error", "gateway", "proxy", "unavailable", "retry", "reload", "错误", "异常", "重试", "刷新", "加载失败", "请求失败",
    ),
}
# What a question asks about when the answer may speak of such things.
TOPICS = {
    "placeholder": r"模板|占位符|变量|字段|placeholder|template|Platzhalter|Vorlage|modèle|plantilla|marcador|プレースホルダ|テンプレート",
    "error": r"(?<![\d.])[45]\d\d(?= ?(?:错误|报错|页|[？?]|$))|\b[45]\d\d (?=errors?\b|page)|[45]\d\d ?(?:错误|报错)|显示 ?[45]\d\d|报错|打不开|错误|无法访问|\berrors?\b|error page|outage|status code|Fehler|erreur|captcha|验证码|登录|log ?in|接口|\bAPI\b|エラー",
    "script": r"javascript|脚本|cookie|\bscripts?\b|スクリプト",
    "filler": r"lorem ipsum|filler|dummy|占位|填充|示例文字|Blindtext|faux[- ]texte|relleno|ダミー",
}


@lru_cache(maxsize=None)
def _compiled(name: str) -> re.Pattern:
    return re.compile("|".join(f"(?:{p})" for p in globals()[name]), re.I | re.M if name != "PLACEHOLDERS" else re.M)


@lru_cache(maxsize=None)
def _topic(kind: str) -> re.Pattern:
    return re.compile(TOPICS[kind], re.I)


#: What every placeholder starts with.
_MARKS = re.compile(
    r"\{[{%A-Za-z_一-鿿\d]|\$[{A-Z]|<[%A-Za-z_一-鿿]|[%#][A-Za-z_一-鿿]|__|@@|\[(?:\[|INSERT|Insert|YOUR|Your|ENTER|Enter|ADD|Add)"
    r"|【(?:请填写|请输入|填写|插入|待填)|（(?:此处插入|此处填写|请填写|待填写)"
)
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]+`", re.S)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+(?:[.,]\d+)*")
_IDS = re.compile(r"\b(?=\w*\d)[\w-]+\b")


def _context(text: str) -> str:
    """A context's form for alignment; numbers and space don't count."""
    return _SPACE.sub(" ", _DIGITS.sub("0", text))


def _words(line: str) -> str:
    """A line's words without numbers, ids and space."""
    return _SPACE.sub(" ", _IDS.sub("0", _DIGITS.sub("0", line.lower()))).strip()


def line_template(line: str) -> str:
    """A digest of a line's words."""
    return hashlib.blake2b(_words(line).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


_SENTENCE = re.compile(r"[。！？!?\n]+|\.(?:\s|$)")


def _sentence(text: str, start: int, end: int) -> tuple[int, int]:
    """The borders of the sentences that [start, end) stands in."""
    before = [m.end() for m in _SENTENCE.finditer(text, 0, start)]
    after = _SENTENCE.search(text, end)
    return before[-1] if before else 0, after.start() if after else len(text)


def residue(question: str | None, text: str | None, screen: bool = True) -> list[tuple]:
    """A row of ``_FOUND`` (but for its id) for each thing in a text that may be residue.

    Of a placeholder, left and right are its contexts; ``alone`` says that it is all of the record
    and ``told`` that the words before it tell the reader to write it. Of a notice, ``line`` is its
    line's template, ``strong`` its wording, ``apart`` whether its sentence is most of its line,
    ``alone`` whether its wording is most of the record, ``asked`` whether the question asks about
    such things. ``screen`` spares texts the patterns whose ``HINTS`` they lack, without influence.
    """
    if not text or not text.strip():
        return []
    code = [m.span() for m in _CODE.finditer(text)] if "`" in text else []
    in_code = lambda m: any(a <= m.start() < b for a, b in code)
    asked: dict[str, bool] = {}

    def asks(kind: str) -> bool:
        if kind not in asked:
            asked[kind] = bool(question) and _topic(kind).search(question) is not None
        return asked[kind]

    whole = text.strip()
    out: list[tuple] = []
    for m in _compiled("PLACEHOLDERS").finditer(text) if not screen or _MARKS.search(text) else ():
        alone = whole == m[0].strip()
        if in_code(m) or (asks("placeholder") and not alone):
            continue
        reach = 4 * CONTEXT
        left, right = _context(text[max(0, m.start() - reach) : m.start()])[-CONTEXT:], _context(text[m.end() : m.end() + reach])[:CONTEXT]
        told = TOLD.search(text[max(0, m.start() - 24) : m.start()]) is not None
        out.append(("placeholder", m[0], left, right, "", False, False, alone, False, told))
    for sentence in re.split(r"[.!?\n]", text):
        if is_pseudo_latin(sentence):
            out.append(("filler", "pseudo-Latin", "", "", line_template(sentence), True, True, False, asks("filler"), False))
            break
    hinted = hints_in(HINTS, text) if screen else HINTS.keys()
    for name, kind in (("FILLER", "filler"), ("SCRIPT", "script"), ("ERROR", "error"), ("WEAK", "error")):
        if name not in hinted:
            continue
        lines: dict[tuple[int, int], list[re.Match]] = {}
        for m in _compiled(name).finditer(text):
            if not in_code(m):
                start, end = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.end())
                lines.setdefault((start, end if end >= 0 else len(text)), []).append(m)
        for (start, end), found in lines.items():
            line = text[start:end]
            said = max(len(_words(line[a:b])) for a,
                b in (_sentence(line, max(0, m.start() - start), min(len(line), m.end() - start)) for m in found))
            one = len([p for p in _SENTENCE.split(whole) if p.strip()]) <= 1
            alone = one or sum(len(m[0]) for m in found) >= 0.5 * len(whole)
            out.append((kind, found[0][0], "", "", line_template(line), name != "WEAK", 2 * said >= len(_words(line)), alone, asks(kind),
                False))
    return out


_FOUND = StructType(
    [StructField(n, StringType()) for n in ("row_id", "kind", "form", "left", "right", "line")] + [StructField(n,
    BooleanType()) for n in ("strong", "apart", "alone", "asked", "told")]
)


def _scan(rows: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(i, *r) for i, q, t in zip(b["row_id"], b["question"], b["text"], strict=True) for r in residue(q, t)]
            yield pd.DataFrame(found, columns=_FOUND.names)

    return rows.select("row_id", "question", "text").mapInPandas(scan, _FOUND)


_STEPS = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64) for k in range(CONTEXT)]


def window_hashes(text: str) -> np.ndarray:
    """A hash of each window of ``CONTEXT`` characters, by its start."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(codes) - CONTEXT + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mixed(sum(((codes[k : k + n] + np.uint64(1)) * step for k, step in enumerate(_STEPS)), start=np.zeros(n, dtype=np.uint64)))


def _hash_column(context: str) -> Column:
    @F.pandas_udf("bigint")
    def hashed(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: int(window_hashes(t).view(np.int64)[0]))

    return hashed(context)


def _fillings(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """(side, context, filling) of ordinary text beside each context, a few of each wherever there are any.

    Windows of the corpus are hashed and looked up in a filter of the contexts; the join with the
    contexts decides on what passes.
    """
    wanted = rows.sparkSession.sparkContext.broadcast(filter_of(contexts.select(_hash_column("context").alias("hash")).distinct(), "hash",
        BROADCAST_CONTEXTS))
    width = 4

    def beside(text: str, start: int, side: str) -> str | None:
        """What stands where the placeholder would; nothing where that is a placeholder itself."""
        end = start + CONTEXT
        part = text[end : end + width] if side == "left" else text[max(0, start - width) : start]
        return None if not part or re.search(r"[{}<>\[\]%#_$【】]|填写|插入", part) else part

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Nothing asks for more than TOLD_FILLINGS fillings, so no more are kept of a context.
        held: dict[tuple[str, str], set[str]] = {}

        def told() -> pd.DataFrame:
            rows_of_part = [(side, context, filling) for (side, context), fillings in held.items() for filling in sorted(fillings)]
            held.clear()
            return pd.DataFrame(rows_of_part, columns=["side", "context", "filling"])

        for b in batches:
            if not wanted.value.any():
                continue
            size = b["text"].str.len().fillna(0).cumsum() // PART_CHARS
            for _, part in b["text"].groupby(size.to_numpy()):
                forms = [_context(t.replace("\0", " ")) for t in part if t]
                ends = np.cumsum([len(f) + 1 for f in forms])
                at = np.flatnonzero(may_hold(wanted.value, window_hashes("\0".join(forms)))) if forms else np.zeros(0, dtype=int)
                owner = np.searchsorted(ends, at, side="right")
                starts = at - np.array([e - len(f) - 1 for e, f in zip(ends, forms, strict=True)], dtype=np.int64)[owner] if len(at) else at
                for start, k in zip(starts.tolist(), owner.tolist(), strict=True):
                    form = forms[k]
                    context = form[start : start + CONTEXT]
                    for side in ("left", "right") if len(context) == CONTEXT else ():
                        fillings = held.setdefault((side, context), set())
                        if len(fillings) < TOLD_FILLINGS and (filling := beside(form, start, side)) is not None:
                            fillings.add(filling)
                if len(held) > HELD:
                    yield told()
        yield told()

    found = rows.select("text").mapInPandas(look, "side string, context string, filling string")
    return found.join(contexts, ["side", "context"], "left_semi")


def notice_score() -> Column:
    """What the features of a notice add up to; ``records`` are those that its line's template repeats in."""
    repeated = F.coalesce(F.col("records") >= PAGES, F.lit(False))
    features = ((F.col("strong"), STRONG), (~F.col("strong"), WEAKLY), (F.col("apart"), APART), (repeated, REPEATED))
    return sum((F.when(on, weight).otherwise(0.0) for on, weight in features), start=F.lit(0.0))


def template_residue(rows: DataFrame, row_id: str = "turn_id", question: str = "question", text: str = "answer") -> DataFrame:
    """(row_id, kind): rows that show template residue, an error page, a notice or filler.

    Kinds are placeholder, filler, script and error. Null, empty and blank texts are no cases, nor
    are texts that speak of such things because the question asks about them, nor code samples. A
    null question asks about nothing. Rows with a null id are left out; repeated rows of an id
    count as one. A placeholder beside other text is a case where another record shows the slot:
    alone of its kind in a table it is none. An empty table gives no rows.
    """
    slim = rows.select(F.col(row_id).cast("string").alias("row_id"), F.col(question).alias("question"),
        F.col(text).alias("text")).where("row_id IS NOT NULL")
    found = cut_lineage(_scan(slim))
    placed = found.where("kind = 'placeholder'")
    sides = placed.where("NOT alone").select("row_id", "form",
        F.posexplode(F.array("left", "right")).alias("at", "context")).where(F.length("context") == CONTEXT)
    sides = sides.withColumn("side", F.when(F.col("at") == 0, "left").otherwise("right"))
    counted = _fillings(slim, sides.select("side", "context").distinct()).groupBy("side",
        "context").agg(F.count_distinct("filling").alias("fillings"))
    broken = sides.groupBy("side", "context").agg(F.count_distinct("row_id").alias("records"))
    aligned = sides.join(counted, ["side", "context"], "left").join(broken, ["side", "context"], "left")
    verdict = aligned.groupBy("row_id", "form").agg(F.max(F.coalesce("fillings", F.lit(0))).alias("fillings"),
        F.max("records").alias("records"))
    # A told placeholder or a mere line to write on needs two fillings; others one, or records with the same fault.
    doubtful = F.col("told") | F.col("form").rlike("^_+$")
    slot = F.when(doubtful, F.col("fillings") >= TOLD_FILLINGS).otherwise((F.col("fillings") >= FILLINGS) | (F.col("records") >= PAGES))
    slots = placed.join(verdict, ["row_id", "form"], "left").where(F.col("alone") | slot).select("row_id", "kind")
    notices = found.where("kind <> 'placeholder'")
    templates = notices.where("NOT asked").groupBy("kind", "line").agg(F.count_distinct("row_id").alias("records"))
    scored = notices.join(templates, ["kind", "line"], "left").withColumn("score", notice_score())
    # Asked about, it is a notice where it stands under other questions too, or is all there is.
    excused = F.col("asked") & ~(F.coalesce(F.col("records") >= PAGES, F.lit(False)) | (F.col("alone") & F.col("strong")))
    pages = scored.where((F.col("score") >= NOTICE) & ~excused).select("row_id", "kind")
    return slots.unionByName(pages).distinct()


def is_residue_free(rows: DataFrame, residues: DataFrame, row_id: str = "turn_id") -> DataFrame:
    """``rows`` without those that ``template_residue`` found; rows with a null id stay."""
    return rows.join(residues.select(F.col("row_id").alias(row_id)).distinct(), row_id, "left_anti")
