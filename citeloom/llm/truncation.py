"""Text cut off by field limits or in transfer (problem 1).

Hidden limits: the length of every text is recomputed under several encodings (characters, UTF-16
units, UTF-8 and GBK bytes, HTML-escaped, JSON-escaped, with CRLF line ends) and counted per group
of rows that share a store; a limit shows as a heap of texts at the greatest length of a group, or
as a heap of texts without a closing mark at any other, since some rows may have passed it by.

Endings: some endings are whole (a closing mark) or broken (half an entity, an open bracket, a
table row without its cells) by themselves. The others are judged by the corpus: the last words
are looked up in all texts, and a text is cut if they are usually followed by more of a sentence.
Ends of texts are what is in question, so they are counted apart: half words and half sentences
come back at them the more often the larger the corpus is, and must not vouch for one another.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from citeloom.llm.bloom import filter_of, may_hold, mixed
from citeloom.session import cut_lineage

#: A heap: this many texts within the width of a cut, and this many times what the lengths below it hold.
HEAP, HEAP_RATIO, BELOW = 5, 4.0, 60
#: Below the greatest length there are many lengths to look at: a heap there is this many standard deviations above its surroundings.
DEVIATIONS = 5.0
#: Phrases that the broadcast filter is sized for (16 MB); with more of them it grows no further and lets more pass.
BROADCAST_PHRASES = 4_000_000
#: Characters whose phrases are counted at once.
PART_CHARS = 400_000
#: Share of whole occurrences under which an ending counts as cut: usually, and at a limit.
OPEN_SHARE, LIMIT_SHARE = 0.5, 0.85
#: Occurrences elsewhere that make the words before an ending known.
KNOWN = 2

# Marks.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"
CLOSING = "。．！？!?；;。〞｡"
QUOTES = "”’」』\"'»）)】]》*_"
CUT_MARKS = re.compile(r"(?:…|\.\.\.|\[\.\.\.\]|（未完）|\[truncated\]|\(truncated\)|（截断）|……?（?展开全文）?|>>|查看更多|read more)\s*$", re.I)
BROKEN = re.compile(r"&#?[A-Za-z0-9]{0,8}$|\\u?[0-9A-Fa-f]{0,3}$|<[A-Za-z/!][^<>\n]{0,80}$|�$|https?:?/{0,2}[\w.-]{0,3}$|[，,、（(《“「『【\[{：:=]$")
BARE_ITEM = re.compile(r"\s*(?:[-*•]|\d{1,2}[.)])$")
SIGN_OFF = re.compile(r"(?:[\U0001F300-\U0001FAFF☀-➿]️?|[~～]|[（(](?:完|end|fin|Ende|終|以上)[)）])\s*$", re.I)
CARD = re.compile(r"(?:^|\n)\d{1,2}:\d{2}\n[^\n]{2,120}\n[A-Za-z0-9_\-一-鿿#?]{2,20}$")
_ITEM = re.compile(r"^[ \t]*(?:[-*•]|\d{1,2}[.)])[ \t]+", re.M)
_OPEN, _CLOSE = "（(《“「『【[", "）)》”」』】]"


#: Phrases that are looked up, the last known one decides: tokens, never beyond the start of a line, and whether names in it are alike.
#: The last of all is the longest without its last token, whatever that is: what else follows there.
PHRASES = ((1, False), (2, False), (3, False), (10, True), (10, False), (10, False))
LONGEST = 10
LAST_PHRASE, BEFORE = len(PHRASES) - 1, len(PHRASES)
#: Tokens of a text that counts as a phrase by itself, its line's start included.
TINY = 5
_MULTIPLIERS = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1) + 0x632BE59BD9B4E019 * k) % 2**64 | 1) for k in range(LONGEST)]
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_NAME, _DIGIT_BASE = np.uint64(1), np.uint64(16)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point below 0x10000 those above are others: runs of letters, of digits and of space are tokens, others by themselves."""
    out = np.full(0x10000, _OTHER, dtype=np.uint8)
    for code in range(0x10000):
        c = chr(code)
        if re.match("[A-Za-zÀ-ÖØ-öø-ÿ’']", c):
            out[code] = _LETTER
        elif "0" <= c <= "9":
            out[code] = _NUMBER
        elif c.isspace():
            out[code] = _SPACE
    return out


class _Tokens:
    """Tokens of texts in arrays: each text starts a line, spaces and list marks are dropped, line feeds kept once.

    ``exact`` counts words as they are, ``alike`` takes capitalised ones for one; numbers count by
    their number of digits. ``text`` is the text of each token, ``place`` its place in its line.
    """

    def __init__(self, texts: Sequence[str]):
        joined = "\0".join(["", *(_ITEM.sub("", t.replace("\0", " ")) for t in texts)])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = np.where(codes < 0x10000, _classes()[np.minimum(codes, 0xFFFF)], _OTHER)
        border = codes == 0
        kind = np.where(border, _OTHER, kind)
        starts = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == _OTHER))) if len(codes) else [])
        sizes = np.diff(np.concatenate((starts, [len(codes)])))
        of_token = kind[starts]
        feeds = np.add.reduceat(codes == 10, starts) > 0
        line = border[starts] | ((of_token == _SPACE) & feeds)
        kept = line | (of_token != _SPACE)
        # A border or a line feed after another one is dropped, but a border stays.
        kept_at = np.flatnonzero(kept)
        again = np.zeros(len(kept_at), dtype=bool)
        again[1:] = line[kept_at][1:] & line[kept_at][:-1] & ~border[starts][kept_at][1:]
        kept_at = kept_at[~again]
        at = np.arange(len(codes)) - np.repeat(starts, sizes)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(sizes.max(initial=1)), 0x9E3779B97F4A7C15, dtype=np.uint64))
            words = mixed(np.add.reduceat(codes.astype(np.uint64) * powers[at], starts) + sizes.astype(np.uint64))
        first = codes[starts]
        number = of_token == _NUMBER
        words = np.where(number, _DIGIT_BASE + np.minimum(sizes, 6).astype(np.uint64), words)
        words = np.where(line, np.uint64(10), words)
        upper = (of_token == _LETTER) & (sizes > 1) & (((first >= 65) & (first <= 90)) | ((first >= 0xC0) & (first <= 0xDE)))
        self.exact, self.alike = words[kept_at], np.where(upper, _NAME, words)[kept_at]
        self.line, first = line[kept_at], first[kept_at]
        self._starts, self._stops = starts[kept_at], np.concatenate((np.flatnonzero(border)[1:], [len(codes)]))
        self.text = np.cumsum(border[starts][kept_at]) - 1
        index = np.arange(len(kept_at))
        self.place = index - np.maximum.accumulate(np.where(self.line, index, 0)) if len(index) else index
        dot = (first == 46) & ~self.line
        mark = self.line | np.isin(first, [ord(c) for c in "。！？!?；;…"])
        next_is = lambda flags, filling: np.concatenate((flags[1:], [filling]))
        after_dot = next_is(dot, False)
        # Whether a unit ends with the token: a mark or a line's end follows, or a dot that belongs to no number and to no row of dots.
        self.ends = next_is(mark, True) | (after_dot & ~next_is(next_is(dot | number[kept_at], False), False) & ~dot)

    def lasts(self, after: Sequence[int]) -> np.ndarray:
        """Place of each text's last token before its closing ``after`` characters."""
        borders = np.flatnonzero(np.concatenate(([True], self.text[1:] != self.text[:-1])))
        return np.maximum(np.searchsorted(self._starts, self._stops - np.asarray(after)) - 1, borders)

    def grams(self) -> list[np.ndarray]:
        """Hashes of the phrases that end at each token, in the order of ``PHRASES``."""
        n, out = len(self.exact), []
        with np.errstate(over="ignore"):
            for level, (length, alike) in enumerate(PHRASES, 1):
                row, total = (self.alike if alike else self.exact) + np.uint64(length + 100 * alike), np.zeros(n, dtype=np.uint64)
                for k in range(level == BEFORE, min(length, n)):
                    back = np.zeros(n, dtype=np.uint64)
                    back[k:] = (row[: n - k] + np.uint64(1)) * _MULTIPLIERS[k]
                    total = total + np.where(self.place >= k, back, np.uint64(0))
                out.append(mixed(total))
        return out


def _tails(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x phrases) hashes of the phrases at the ends of texts, and whole texts' numbers of tokens, their line's start included; ``LONGEST`` + 1 for longer ones or several lines."""
    if not len(texts):
        return np.zeros((0, len(PHRASES)), dtype=np.int64), np.zeros(0, dtype=np.int64)
    reach = [64] * len(texts)
    grams, counts = np.zeros((len(texts), len(PHRASES)), dtype=np.int64), np.full(len(texts), LONGEST + 1)
    waiting = list(range(len(texts)))
    while waiting:
        tokens = _Tokens([texts[i][-reach[i] :] for i in waiting])
        last = np.flatnonzero(np.concatenate((tokens.text[1:] != tokens.text[:-1], [True])))
        held = np.diff(np.concatenate(([-1], last)))
        found = np.stack([g[last].view(np.int64) for g in tokens.grams()], axis=1)
        later = []
        for k, i in enumerate(waiting):
            # Where the tail starts inside a line, its border, its first token and a list mark's rest are no true ones.
            inside = reach[i] < len(texts[i]) and tokens.place[last[k]] == held[k] - 1
            if inside and tokens.place[last[k]] <= LONGEST:
                reach[i] *= 2
                later.append(i)
                continue
            grams[i] = found[k]
            if reach[i] >= len(texts[i]) and "\n" not in texts[i].strip():
                counts[i] = held[k]
        waiting = later
    return grams, counts


def _pieces(text: str) -> Iterator[str]:
    """A text without its closing blanks, cut after line feeds into pieces of about ``PART_CHARS``; no phrase goes beyond a line, and all but the last end with their line feed."""
    text, at = text.rstrip(), 0
    while len(text) - at > PART_CHARS:
        cut = text.rfind("\n", at, at + PART_CHARS)
        cut = cut if cut > at else text.find("\n", at + PART_CHARS)
        if cut < 0:
            break
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def _parts(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Pieces of texts in parts of about ``PART_CHARS``, so that long texts don't add up in memory."""
    part, size = [], 0
    for text in texts:
        for piece in _pieces(text or ""):
            if piece.strip():
                part.append(piece)
                size += len(piece)
            if size >= PART_CHARS:
                yield part
                part, size = [], 0
    if part:
        yield part


def _gram_counts(wanted: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """(level, gram, ends, total, lasts, lines): occurrences of wanted phrases within texts, those where a unit ends there, and apart from both those where a text ends, with a bit for what stands before the last line."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for texts in _parts(b["text"]):
                tokens = _Tokens(texts)
                last = np.zeros(len(tokens.exact), dtype=bool)
                last[tokens.lasts([len(t) - len(t[: _end(t)].rstrip()) if t[-1] != "\n" else 0 for t in texts])] = True
                inner_end, inner = tokens.ends & ~last, ~last
                grams = tokens.grams()
                # The end of the line before a text's last one; texts of one line are alike.
                start = np.arange(len(last)) - tokens.place
                first = np.concatenate(([True], tokens.text[1:] != tokens.text[:-1]))
                bits = np.where(last & ~first[start], np.uint64(1) << (grams[2][start - 1] & np.uint64(63)), last.astype(np.uint64))
                for level, gram in enumerate(grams, 1):
                    at = np.flatnonzero(may_hold(wanted.value, gram))
                    unique, inverse = np.unique(gram[at].view(np.int64), return_inverse=True)
                    lines = np.zeros(len(unique), dtype=np.uint64)
                    np.bitwise_or.at(lines, inverse, bits[at])
                    times = lambda flags: np.bincount(inverse, weights=flags[at], minlength=len(unique)).astype(np.int64)  # noqa: B023, E731
                    yield pd.DataFrame(
                        {
                            "level": np.full(len(unique), level, dtype=np.int32),
                            "gram": unique,
                            "ends": times(inner_end),
                            "total": times(inner),
                            "lasts": times(last),
                            "lines": lines.view(np.int64),
                        }
                    )

    return count


def _mark(stripped: str) -> re.Match | None:
    """The mark that a cut may have left at the end."""
    return None if stripped.endswith("……") else CUT_MARKS.search(stripped, max(0, len(stripped) - 40))


def _open_dot(core: str) -> bool:
    """Whether the closing dot may belong to a number or a mark."""
    return core.endswith(".") and bool(core[-2:-1].isdigit() or re.search("[一-鿿]{4}", core[-12:]))


def _end(stripped: str) -> int:
    """Where the part of a text ends that ``inspect`` has looked up."""
    if mark := _mark(stripped):
        return mark.start()
    core = stripped.rstrip(QUOTES)
    return len(core) - 1 if _open_dot(core) else len(stripped)


def inspect(text: str | None) -> tuple[str, str]:
    """('whole' | 'cut' | 'open' | 'marked', what to look up): the ending by itself.

    'open' needs the corpus; 'marked' ends with a mark that a cut may have left.
    """
    if not text or not text.strip():
        return "whole", ""
    stripped = text.rstrip()
    last = stripped[stripped.rfind("\n") + 1 :]
    # The longest of each set of patterns tells how far back it can reach.
    if BROKEN.search(stripped, max(0, len(stripped) - 100)) or BARE_ITEM.match(last):
        return "cut", ""
    if stripped.count("```") % 2:
        return "cut", ""
    if stripped.endswith("```"):
        return "whole", ""
    if last.lstrip().startswith("|"):
        rows = [r for r in stripped.split("\n") if r.lstrip().startswith("|")]
        widths = [r.count("|") for r in rows]
        return ("whole" if last.endswith("|") and last.count("|") >= max(widths[:-1], default=0) else "cut"), ""
    if last.count("**") % 2:
        return "cut", ""
    if SIGN_OFF.search(stripped, max(0, len(stripped) - 20)):
        return "whole", ""
    if mark := _mark(stripped):
        return "marked", stripped[: mark.start()].rstrip()
    clause = re.split(r"[。！？!?]", last)[-1]
    core = stripped.rstrip(QUOTES)
    if core and core[-1] in CLOSING or core.endswith("……"):
        return "whole", ""
    if core.endswith("."):
        return ("open", core[:-1]) if _open_dot(core) else ("whole", "")
    if sum(clause.count(c) for c in _OPEN) > sum(clause.count(c) for c in _CLOSE) or clause.count('"') % 2:
        return "cut", ""
    if CARD.search(stripped, max(0, len(stripped) - 160)):
        return "whole", ""  # a recommendation card: duration, title, creator
    return "open", stripped


#: Name of each measure of length and the width of a cut under it.
MEASURES = {"characters": 1, "utf16": 2, "utf8": 4, "gbk": 2, "html": 6, "html_utf8": 6, "json": 2, "json_utf8": 4, "json_ascii": 6,
    "crlf": 2, "crlf_utf8": 4}


def lengths_of(texts: Sequence[str]) -> np.ndarray:
    """(texts x ``MEASURES``) lengths, a partial last character left out; each character class is counted once."""
    texts = [t.rstrip("�") for t in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(n)

    def times(flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return upto[ends] - upto[ends - n]

    wide, far = times(codes > 0x7F), times(codes > 0xFFFF)
    u8 = n + wide + times(codes > 0x7FF) + far
    feed = times(codes == 10)
    pair = np.concatenate((codes[1:] == 10, [False])) & (codes == 13) if len(codes) else codes == 13
    pair[ends[(n > 0) & (ends < len(codes))] - 1] = False  # not across two texts
    feeds = feed - times(pair)
    quotes = times(codes == 34)
    html = n + 4 * times(codes == 38) + 3 * (times(codes == 60) + times(codes == 62)) + 5 * (quotes + times(codes == 39))
    escape = quotes + times(codes == 92) + feed + times(codes == 13) + times(codes == 9)
    sizes = {
        "characters": n, "utf16": n + far, "utf8": u8, "gbk": n + wide, "html": html, "html_utf8": html + u8 - n, "json": n + escape,
        "json_utf8": u8 + escape,
        "json_ascii": n + escape + 5 * wide, "crlf": n + feeds, "crlf_utf8": u8 + feeds,
    }
    return np.stack([sizes[m] for m in MEASURES], axis=1)


_LENGTHS, _PHRASES = [f"_m{i}" for i in range(len(MEASURES))], [f"_p{i}" for i in range(1, len(PHRASES) + 1)]


def _facts(rows: DataFrame, endings: bool = True) -> DataFrame:
    """One scan of texts (column ``text``, replaced by what is told of it): copies' hash, whether it lacks a closing mark, lengths and, with ``endings``, its ending and what is to be looked up."""
    keep = [c for c in rows.columns if c != "text"]
    own = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    told = ["state", "short", "in_word", *_PHRASES] if endings else []
    kinds = ["state string", "short int", "in_word boolean", *[f"{p} bigint" for p in _PHRASES]] if endings else []
    schema = ", ".join([own, "_same bigint", "_open int", *[f"{m} bigint" for m in _LENGTHS], *kinds])

    def one(b: pd.DataFrame) -> pd.DataFrame:
        texts = list(b["text"])
        out = b[[*keep, "_same"]].reset_index(drop=True)
        out["_open"] = np.array([t.rstrip().rstrip(QUOTES)[-1:] not in (*CLOSING, ".", "…") for t in texts], dtype=np.int32)
        out[_LENGTHS] = lengths_of(texts)
        if endings:
            states, rests = zip(*map(inspect, texts), strict=True)
            asked = [i for i, (s, r) in enumerate(zip(states, rests, strict=True)) if s not in ("whole", "cut") and r]
            grams, counts = np.zeros((len(texts), len(PHRASES)), dtype=np.int64), np.full(len(texts), LONGEST + 1)
            grams[asked], counts[asked] = _tails([rests[i] for i in asked])
            out["state"], out["short"] = states, np.where(counts <= TINY, 2, np.where(counts <= LONGEST, 1, 0)).astype(np.int32)
            out["in_word"] = [r[-1:].isalpha() and not re.search("[\u3040-\u9fff]", r[-1:]) for r in rests]
            out[_PHRASES] = grams
        return out[[*keep, "_same", "_open", *_LENGTHS, *told]]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            part = b["text"].str.len().cumsum() // PART_CHARS
            for _, rows_of_part in b.groupby(part.to_numpy(), sort=True):
                yield one(rows_of_part)

    return rows.where(F.col("text").isNotNull()).select(*keep, "text", F.xxhash64("text").alias("_same")).mapInPandas(scan, schema)


def hidden_limits(rows: DataFrame, groups: Sequence[str], text: str = "text") -> DataFrame:
    """(groups, measure, limit_length, width, texts): heaps of texts at any length of a group.

    At the greatest length all texts count; below it only those without a closing mark, since texts
    that a limit cut stop anywhere, and they must stand out from both sides. Copies of a text count
    once; null and empty texts don't count. Below a few widths there is nothing to stand out from.
    """
    names = [f"_s{i}" for i in range(len(groups))]
    slim = rows.select(F.col(text).alias("text"), *[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)]).where("text <> ''")
    return _heaps(_facts(slim, endings=False), names).withColumnsRenamed(dict(zip(names, groups, strict=True)))


def _heaps(facts: DataFrame, groups: Sequence[str]) -> DataFrame:
    sized = facts.dropDuplicates([*groups, "_same"]).select(*groups, "_open", F.posexplode(F.array(*_LENGTHS)).alias("at", "length"))
    names, widths = F.array(*[F.lit(m) for m in MEASURES]), F.array(*[F.lit(w) for w in MEASURES.values()])
    counted = sized.where("length > 0").groupBy(*groups, "at", "length").agg(F.count(F.lit(1)).alias("n"), F.sum("_open").alias("open"))
    lengths = counted.select(*groups, F.get(names, F.col("at")).alias("measure"), F.get(widths, F.col("at")).alias("width"), "length", "n",
        "open")
    # A histogram: one row per group, measure and length, whatever the number of texts.
    one = Window.partitionBy(*groups, "measure")

    def around(first: int, last: int) -> WindowSpec:
        return one.orderBy("length").rangeBetween(first, last)

    def by_width(of: Callable[[int], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("width") == w, of(w)) for w in sorted(set(MEASURES.values()))])

    near = lengths.withColumns(
        {
            "greatest": F.col("length") == F.max("length").over(one),
            "texts": by_width(lambda w: F.sum("n").over(around(1 - w, 0))),
            "open_texts": by_width(lambda w: F.sum("open").over(around(1 - w, 0))),
            "to_here": F.sum("n").over(around(1 - BELOW, 0)),
            "open_to_here": F.sum("open").over(around(1 - BELOW, 0)),
            "open_above": F.coalesce(F.sum("open").over(around(1, BELOW)), F.lit(0)),
        }
    )
    below = F.least(F.lit(BELOW), F.col("length")) - F.col("width")  # as many lengths as there are
    near = near.withColumn("below", below).where(F.col("below") >= HEAP_RATIO * F.col("width"))
    usual = (F.col("to_here") - F.col("texts")) / F.col("below") * F.col("width")
    usual_open = F.greatest((F.col("open_to_here") - F.col("open_texts")) / F.col("below"), F.col("open_above") / BELOW) * F.col("width")
    at_top = F.col("greatest") & (F.col("texts") >= HEAP) & (F.col("texts") >= HEAP_RATIO * (usual + 0.5))
    inside = (F.col("open_texts") >= HEAP) & (F.col("open_texts") >= HEAP_RATIO * (usual_open + 0.5)) & (F.col("open_texts") >= usual_open + DEVIATIONS * F.sqrt(usual_open + 1))
    # Of the lengths that share a heap, the one that holds most of it.
    heap = near.where(at_top | inside).withColumn("rank", F.struct("texts", -F.col("length")))
    heap = heap.withColumn("best", by_width(lambda w: F.max("rank").over(around(1 - w, w - 1)))).where(F.col("rank") == F.col("best"))
    return heap.select(*groups, "measure", "width", F.col("length").alias("limit_length"), "texts")


def find_truncated(rows: DataFrame, row_id: str, text: str, groups: Sequence[str] = ()) -> DataFrame:
    """(row_id, at_limit, evidence): texts that stop inside a word, a sentence or another unit.

    ``groups`` are the columns that tell stores apart for the hidden limits. Null, empty and blank
    texts are no cases; neither are texts that end with a closing mark, a sign-off, a whole list
    item or table row. Rows with a null id are left out; repeated rows of an id count as one, and
    rows of one text, whatever their ids, are one text to the phrase counts, so copies don't vouch
    for one another. An empty table gives no rows; a corpus too small to know an ending leaves it
    whole unless the ending is broken by itself or stands at a limit.
    """
    stores = [F.col(g) for g in groups] or [F.lit(0)]  # without groups all texts are of one store
    names = [f"_g{i}" for i in range(len(stores))]
    slim = rows.select(
        F.col(row_id).cast("string").alias("row_id"), F.col(text).alias("text"), *[c.alias(n) for c, n in zip(stores, names, strict=True)]
    ).where("row_id IS NOT NULL AND text IS NOT NULL")
    facts = cut_lineage(_facts(slim))
    # One row per group with its heaps: a small table whatever the number of texts.
    heaps = _heaps(facts.where("_m0 > 0"), names).groupBy(*names).agg(F.collect_list(F.struct("measure", "width",
        "limit_length")).alias("heaps"))
    heaps = heaps.select(*[F.col(n).alias(f"h{n}") for n in names], "heaps")
    unsure = facts.where("state <> 'whole'").withColumn("lengths", F.array(*_LENGTHS))
    held = unsure.join(heaps, [F.col(n).eqNullSafe(F.col(f"h{n}")) for n in names], "left")
    names_of = F.array(*[F.lit(m) for m in MEASURES])
    at_limit = F.coalesce(
        F.exists("heaps", lambda h: F.get("lengths", F.array_position(names_of,
        h["measure"]).cast("int") - 1).between(h["limit_length"] - h["width"] + 1, h["limit_length"])), F.lit(False)
    )
    judged = held.withColumn("at_limit", at_limit).withColumn("state",
        F.when((F.col("state") == "marked") & F.col("at_limit"), "cut").otherwise(F.col("state")))
    judged = cut_lineage(judged.select("row_id", "at_limit", "state", "short", "in_word", *_PHRASES))
    # What is cut by itself looks nothing up: it gets a key of its own that no phrase has.
    cut = F.col("state") == "cut"
    lookups = F.when(cut, F.array(F.struct(F.lit(0).alias("level"), F.xxhash64("row_id").alias("gram")))).otherwise(
        F.array(*[F.struct(F.lit(n).alias("level"), F.col(p).alias("gram")) for n, p in enumerate(_PHRASES, 1)])
    )
    looked_up = judged.where(~cut).select(F.inline(lookups)).distinct()
    # Each text once: the end of a copy says nothing about its own ending.
    texts = slim.select(F.rtrim("text", F.lit(BLANKS)).alias("text")).distinct()
    wanted_phrases = slim.sparkSession.sparkContext.broadcast(filter_of(looked_up.select("gram").distinct(), "gram", BROADCAST_PHRASES))
    # What passes the filter unasked finds no partner in the join below.
    counts = texts.mapInPandas(_gram_counts(wanted_phrases), "level int, gram bigint, ends bigint, total bigint, lasts bigint, lines bigint")
    stats = counts.groupBy("level", "gram").agg(F.sum("ends").alias("ends"), F.sum("total").alias("total"), F.sum("lasts").alias("lasts"),
        F.bit_count(F.bit_or("lines")).cast("bigint").alias("lines"))
    wanted = judged.select("row_id", "at_limit", "state", "short", "in_word", F.inline(lookups))
    known = wanted.join(stats, ["level", "gram"], "left")
    seen = known.groupBy("row_id", "at_limit", "state", "short", "in_word").agg(
        *[F.coalesce(F.max(F.when(F.col("level") == n, F.col(c))), F.lit(0)).alias(f"{c}{n}") for n in range(1,
        len(PHRASES) + 1) for c in ("ends", "total", "lasts", "lines")]
    )

    def others(level: int) -> Column:
        """Other texts that end so: the text's own ending, counted once for all its copies, does not count."""
        return F.greatest(F.col(f"lasts{level}") - 1, F.lit(0))

    def share(level: int) -> Column:
        """Whole share of the occurrences within texts; ends of texts, the own one among them, don't count."""
        return F.when(F.col(f"total{level}") >= KNOWN, F.col(f"ends{level}") / F.col(f"total{level}"))

    longest = share(LAST_PHRASE)
    limit = F.when(F.col("at_limit"), LIMIT_SHARE).otherwise(OPEN_SHARE)
    backed = F.coalesce(*[share(n) for n in range(LAST_PHRASE, 0, -1)], F.lit(0.0))
    # A short text is its own phrase: what the corpus knows of shorter ones says little about it.
    # A word stands within texts more often than other texts stop after it, half a word does not.
    unknown_word = F.col("in_word") & (F.col("total1") <= others(1))
    # A sign-off: what stands before its last token is usually followed by it at the end of a text, after several other lines.
    otherwise = F.col(f"total{BEFORE}") - F.col(f"ends{LAST_PHRASE}")
    closing = (F.col(f"lines{LAST_PHRASE}") > KNOWN) & (others(LAST_PHRASE) > otherwise)
    own = F.when(F.col("short") == 2, F.coalesce(longest, F.lit(1.0)) < limit).otherwise((F.coalesce(longest, share(3),
        F.lit(1.0)) < limit) | unknown_word)
    open_end = F.when((F.col("short") > 0) & ~F.col("at_limit"), own).otherwise((backed < limit) | unknown_word)
    found = seen.where(cut | (open_end & ~closing)).select("row_id", "at_limit",
        F.when(cut, "broken").when(F.col("state") == "marked", "mark").otherwise("ending").alias("evidence"))
    return found.groupBy("row_id").agg(F.max("at_limit").alias("at_limit"), F.min("evidence").alias("evidence"))


def truncation_shares(answers: DataFrame, found: DataFrame, groups: Sequence[str], row_id: str) -> DataFrame:
    """(groups, answers, cut_answers, cut_share): how often each group of rows is cut; ids count once."""
    once = answers.where(F.col(row_id).isNotNull()).select(row_id, *groups).distinct()
    marked = once.join(found.select(F.col("row_id").alias(row_id), F.lit(1).alias("cut")), row_id, "left")
    return marked.groupBy(*groups).agg(F.count(F.lit(1)).alias("answers"), F.count("cut").alias("cut_answers")).withColumn("cut_share",
        F.col("cut_answers") / F.col("answers"))
