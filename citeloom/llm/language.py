"""Language of prose by script and function words."""

from __future__ import annotations

import re
from functools import lru_cache

# Function words that tell five languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in is it that for on with as are was by be this from or have has had an at not but which its their they when who will would can there been more only than into about most some other one two after before you your we our so if does do did how what why no",
    "de": "der die das und ist nicht ein eine einen einem eines von zu mit auf für im in den dem des sich auch als wird werden wurde an bei aus nach um es man nur oder sollte so hat haben war sind wie noch etwa damit dass sie ihr ihre kein keine klaren was wer gibt kann muss darf ich mir mich",
    "fr": "le la les de des du un une et est en pour que qui dans sur par plus ne pas ce cette ces au aux avec se son sa ses ou il elle on nous vous leur mais dont été entre plutôt chez sont peut sans après avant deux depuis surtout faut je me",
    "es": "el la los las de del un una y es en por para que se con no su sus al lo como más pero o si este esta hay entre sobre unos unas solo desde hasta muy ya todo son ha han puede sin antes después dos qué le nos",
}
_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿß]+(?:['’][A-Za-zÀ-ÿ]+)?")
_KANA = re.compile(r"[぀-ヿ]")
_HAN = re.compile(r"[一-鿿]")
_NOT_PROSE = re.compile(
    r"```.*?(?:```|\Z)|`[^`\n]*`|https?://\S+|^\s*\[\d+\][^\n]*$|^\s*\|.*$|“[^”\n]*”|「[^」\n]*」|『[^』\n]*』|«[^»\n]*»|„[^“”\n]*[“”]|\"[^\"\n]*\"", re.S | re.M
)


@lru_cache(maxsize=1)
def _lexicon() -> dict[str, tuple[str, ...]]:
    """Function word to the languages it belongs to."""
    out: dict[str, tuple[str, ...]] = {}
    for lang, words in FUNCTION_WORDS.items():
        for w in words.split():
            out[w] = (*out.get(w, ()), lang)
    return out


_MARKED = re.compile(r"[`“\"「『«„|\[]|https?:")


def prose(text: str) -> str:
    """A text without code, links, citations, tables and quotations."""
    if not _MARKED.search(text):
        return text
    return _NOT_PROSE.sub(" ", text)


def language(text: str) -> str | None:
    """zh, ja, en, de, fr, es, or None where nothing tells.

    Kana make Japanese where they are a tenth of the letters, Han alone Chinese; Latin prose is of
    the language whose function words it holds most of, at least two and more than any other.
    """
    kana, han = len(_KANA.findall(text)), len(_HAN.findall(text))
    words = [w.lower() for w in _WORD.findall(text)]
    if kana >= 3 and kana >= 0.1 * (kana + han) and kana + han >= len(words):
        return "ja"
    lexicon, scores = _lexicon(), dict.fromkeys(FUNCTION_WORDS, 0)
    for w in words:
        for lang in lexicon.get(w) or lexicon.get(re.split("['’]", w)[0] if "'" in w or "’" in w else "", ()):
            scores[lang] += 1
    best = max(scores, key=scores.get)  # type: ignore[arg-type]
    latin = scores[best] >= 2 and scores[best] > max(n for lang, n in scores.items() if lang != best) and scores[best] >= 0.12 * len(words)
    # A Han name counts as one word beside Latin prose.
    if latin and scores[best] * 2 >= han / 4:
        return best
    return "zh" if han >= 3 and han >= len(words) else best if latin else None


_BEYOND_LATIN = re.compile(r"[0-9Ͱ-\U0010FFFF]")


def is_pseudo_latin(sentence: str, least: int = 8) -> bool:
    """Whether a sentence is filler: Latin letters only, many words, none of them a function word."""
    if _BEYOND_LATIN.search(sentence):
        return False
    words = [w.lower() for w in _WORD.findall(sentence)]
    if len(words) < least:
        return False
    known = _lexicon()
    return not any(w in known for w in words) and len(set(words)) < 0.95 * len(words) + 1
