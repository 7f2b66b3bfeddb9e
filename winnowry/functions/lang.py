"""Language identification, charset decoding and script conversion.

The detector is pluggable: any picklable callable from text to (language, score). The one here votes with function words and
scripts; it stands in for a trained model and makes no claim to match one.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import pieces

WORDS = {
    "en": "the of and to in is that it for as with was on be by this are from or an".split(),
    "de": "der die und das von zu mit ist den nicht des ein eine für als im sich auch dem auf".split(),
    "fr": "le la les de des et en un une du que pour dans est par qui sur pas avec ce".split(),
    "es": "el la los de que y en un una se del las por con no para su al lo es".split(),
}
SCRIPTS = [("ja", re.compile("[぀-ヿ]")), ("ko", re.compile("[가-힣]")), ("zh", re.compile("[一-龥]")), ("ru", re.compile("[а-яА-Я]")), ("ar", re.compile("[؀-ۿ]"))]
#: Labels of other families, by the ones used here.
LABELS = {"zho_Hans": "zh", "zho_Hant": "zh", "yue_Hant": "zh", "zh-cn": "zh", "eng_Latn": "en"}


def guess(text: str) -> tuple[str, float]:
    """Language and share of the evidence; ("unknown", 0.0) without any."""
    text = text.replace("\0", "")
    letters = sum(c.isalpha() for c in text)
    for name, script in SCRIPTS:
        n = len(script.findall(text))
        if letters and n > 0.3 * letters:
            return name, min(1.0, n / letters)
    words = re.findall(r"\w+", text.lower())
    votes = {k: sum(w in v for w in words) for k, v in ((k, set(v)) for k, v in WORDS.items())}
    total = sum(votes.values())
    if not total:
        return "unknown", 0.0
    best = max(sorted(votes), key=lambda k: votes[k])
    return best, votes[best] / total


def detect(text: Column, detector: Callable[[str], tuple[str, float]] = guess, first: int | None = None, least: float = 0.0) -> Column:
    """struct<lang, score>; `first` characters are looked at, scores up to `least` are "unknown"."""

    def one(t: str | None) -> dict:
        lang, score = detector(t.replace("\n", " ")[:first]) if t else ("unknown", 0.0)
        return {"lang": LABELS.get(lang, lang), "score": min(1.0, score)} if score > least else {"lang": "unknown", "score": 0.0}

    return pieces.mapped(one, "lang string, score float", pa.struct([("lang", pa.string()), ("score", pa.float32())]), text)


MARKS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]


def decode(data: bytes, charsets: tuple[str, ...] = ("gb18030", "shift_jis", "euc_kr", "big5")) -> str | None:
    """Text of bytes: by byte-order mark, as UTF-8, then by the first charset that reads them as mostly letters; else none."""
    for mark, name in MARKS:
        if data.startswith(mark):
            try:
                return data.decode(name)
            except UnicodeDecodeError:
                return None
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        pass
    for name in charsets:
        try:
            text = data.decode(name)
        except UnicodeDecodeError:
            continue
        other = [c for c in text if ord(c) > 127]
        common = sum("一" <= c <= "龥" or "぀" <= c <= "ヿ" or "가" <= c <= "힣" or c in "，。、！？；：「」（）" for c in other)
        if other and common >= 0.7 * len(other):
            return text
    return None


def decoded(body: Column) -> Column:
    return pieces.mapped(lambda b: None if b is None else decode(b), "string", pa.string(), body)


#: A few traditional characters and their simplified forms; a full table is a parameter.
TRADITIONAL, SIMPLIFIED = "國學語說時間門開關書會來為這個們對們過還電車長東馬鳥魚", "国学语说时间门开关书会来为这个们对们过还电车长东马鸟鱼"


def simplify(text: Column, traditional: str = TRADITIONAL, simplified: str = SIMPLIFIED) -> Column:
    """Character by character; phrases aren't looked at."""
    return F.translate(text, traditional, simplified)


def converted(text: Column, table: dict[str, str]) -> Column:
    """text with the leftmost-longest matches of the table's keys replaced, phrases so before the characters in them; what is put in isn't searched again.

    Only places of first characters are looked at, and there only the lengths that keys of that character have. Empty keys are left out. Null texts stay null.
    """
    table = {k: v for k, v in table.items() if k}
    lengths: dict[str, list[int]] = {}
    for n, c in sorted({(len(k), k[0]) for k in table}, reverse=True):
        lengths.setdefault(c, []).append(n)
    first = re.compile("[" + "".join(map(re.escape, sorted(lengths))) + "]") if table else None

    def one(t: str | None) -> str | None:
        if not t or first is None:
            return t
        out, at = [], 0
        while m := first.search(t, at):
            i = m.start()
            n = next((n for n in lengths[t[i]] if t[i : i + n] in table), 0)
            out += (t[at:i], table[t[i : i + n]] if n else t[i])
            at = i + (n or 1)
        return "".join((*out, t[at:]))

    return pieces.mapped(one, "string", pa.string(), text)
