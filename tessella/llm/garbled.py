"""Garbled text from wrong character encodings: finding and restoring it.

Method: for every pair of encodings the garbled form of every usual character
is precomputed, all forms go into one multi-pattern automaton, and only spans
that the automaton matched are put back; correct text around them stays.

A form says which pairs make it.  Encodings of one byte a character give each
character a form of its own.  For those of two bytes a form is the first two
characters that come out, which hold the whole character and the first byte of
the next one.  Forms that also occur in proper writing count only in runs.

Pairs that show whole characters as other whole characters (Cyrillic in
another Cyrillic code, one double-byte code in another) have no such forms.
For them every character that is odd in the text opens a span, and the span
counts as garbled if one pair turns it back without a remainder into usual
writing.  A span is only ever replaced if the pair, gone through again, gives
exactly what was seen; of several pairs the one with the most usual result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values: (written in, read as).
PAIRS = (
    ("utf-8", "cp1252"),
    ("utf-8", "latin-1"),
    ("utf-8", "gb18030"),
    ("utf-8", "cp932"),
    ("utf-8", "big5"),
    ("utf-8", "mac_roman"),
    ("utf-8", "cp437"),
    ("utf-8", "cp850"),
    ("utf-8", "cp1251"),
    ("utf-8", "koi8_r"),
    ("utf-8", "iso8859_15"),
    ("utf-8", "cp1250"),
    ("utf-8", "iso8859_2"),
    ("gbk", "latin-1"),
    ("gbk", "cp1252"),
    ("big5", "latin-1"),
)
#: What whole characters may have been written in, and the script that then shows.
SCRIPTS = {
    "cp1251": "cyrillic",
    "koi8_r": "cyrillic",
    "iso8859_5": "cyrillic",
    "cp866": "cyrillic",
    "euc_kr": "hangul",
    "cp932": "kana",
    "euc_jp": "kana",
    "gbk": "hanzi",
    "big5": "hanzi",
}
#: What they may have been read as.
READ_AS = ("latin-1", "cp1252", "cp1250", "cp1251", "koi8_r", "iso8859_5", "cp866", "mac_roman", "cp437", "gbk", "big5", "cp932", "euc_kr")
#: Every other pair of the two, as they are tried.
WHOLE = tuple((w, r) for w in SCRIPTS for r in READ_AS if w != r)
DOUBLE_BYTE = {"gb18030", "big5", "cp932"}
#: Marks of a loss that no pair undoes, and what memory filled with a debug byte looks like.
LOST = ("�", "锟斤拷", "锟斤", "斤拷", "烫烫烫", "屯屯屯")
#: Control characters that no text is written with (the next-line control aside): bytes shown as themselves.
CONTROLS = tuple(chr(c) for c in range(0x80, 0xA0) if c != 0x85)
#: Opening and closing quotation marks.
QUOTES = {"“": "”", "\"": "\"", "「": "」", "『": "』", "‘": "’", "《": "》"}


def hanzi(first: int, last: int) -> list[str]:
    """The characters of the rows ``first`` to ``last`` of the public GB 2312 table."""
    out = []
    for row in range(first, last + 1):
        for cell in range(1, 95):
            try:
                out.append(bytes((row + 0xA0, cell + 0xA0)).decode("gb2312"))
            except UnicodeDecodeError:
                pass
    return out


def usual_characters() -> list[str]:
    """What texts are likely written with: level-one hanzi, CJK and general punctuation, accented letters."""
    signs = [chr(c) for r in ((0x80, 0x17F), (0x2010, 0x2027), (0x2030, 0x203A), (0x3000, 0x3020), (0xFF01, 0xFF5E)) for c in range(*r)]
    return hanzi(16, 55) + signs + ["€", "™", "→", "≠", "∑", "√", "−", "×"] + [chr(c) for c in range(0x3041, 0x30FF)]


def other_characters() -> list[str]:
    """What else a line may be written with: other scripts, marks, symbols; the usual hangul of the public KS X 1001 table."""
    ranges = ((0x2000, 0x2070), (0x300, 0x370), (0x391, 0x3CA), (0x410, 0x450), (0x5D0, 0x5EB), (0x627, 0x64B), (0x2190, 0x2200), (0x2200, 0x2300), (0x2500, 0x2600), (0x2700, 0x27C0), (0xFE00, 0xFE10), (0xFF61, 0xFFA0), (0x1D400, 0x1D800), (0x1F300, 0x1F700), (0x1F900, 0x1FA00))
    hangul = [bytes((row, cell)).decode("euc-kr") for row in range(0xB0, 0xC9) for cell in range(0xA1, 0xFF)]
    return [chr(c) for r in ranges for c in range(*r)] + hangul


def _table(encoding: str) -> str:
    """What each of the 256 bytes shows as in a one-byte encoding; undefined ones stay controls."""
    out = []
    for b in range(256):
        try:
            out.append(bytes((b,)).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


ONE_BYTE = {read for _, read in PAIRS if read not in DOUBLE_BYTE} | {r for r in (*READ_AS, *SCRIPTS) if SCRIPTS.get(r) in (None, "cyrillic")}
SHOWN = {read: _table(read) for read in sorted(ONE_BYTE)}
BYTE_OF = {read: {c: b for b, c in enumerate(shown)} for read, shown in SHOWN.items()}


def misread(data: bytes, encoding: str) -> str:
    """The characters that a careless reader shows for ``data``."""
    if encoding in SHOWN:
        return data.decode("latin-1").translate(SHOWN[encoding])
    return data.decode(encoding, "replace")


def unread(text: str, encoding: str) -> bytes:
    """The bytes that ``encoding`` showed as ``text``; raises UnicodeError if it can't have."""
    if encoding in BYTE_OF:
        back = BYTE_OF[encoding]
        try:
            return bytes(back[c] for c in text)
        except KeyError:
            raise UnicodeError(text) from None
    return text.encode(encoding)


COMMON = frozenset(hanzi(16, 55)) | frozenset(map(chr, range(0x20, 0x7F))) | frozenset("，。、：；？！“”‘’（）《》—…·　\n\r\t")
LETTERS = frozenset(chr(c) for c in range(0xC0, 0x180) if c not in (0xD7, 0xF7)) | {"ƒ"}
#: A text of nothing but these holds no form that counts.
UNUSUAL = re.compile("[^" + re.escape("".join(sorted(COMMON | {c for c in LETTERS if c.islower() and ord(c) < 0x100} | set("ÀÄÇÉÈÊÖÓÜÑœ¿¡«»")))) + "]")


def garbled_forms() -> dict[str, tuple[tuple[int, ...], bool]]:
    """Every garbled form to (its pairs' numbers, whether one of it is proof)."""
    usual, other = usual_characters(), other_characters()
    forms: dict[str, tuple[tuple[int, ...], bool]] = {}
    for n, (written, read) in enumerate(PAIRS):
        # One following character for each first byte that may come next.
        heads: dict[int, bytes] = {}
        coded: list[tuple[bytes, bool]] = []
        for rare, c in [*((False, c) for c in [*usual, "a"]), *((True, c) for c in other)]:
            try:
                data = c.encode(written)
            except UnicodeEncodeError:
                continue
            if not rare:
                heads.setdefault(data[0], data)
            if len(data) > 1:
                coded.append((data, rare))
        for own, rare in coded:
            # Rarer characters are followed by their like or by plain ASCII.
            after = (own, b"a", b" ", b"\n") if rare else heads.values()
            shown = {misread(own + h, read)[:2] for h in after} if read in DOUBLE_BYTE else (misread(own, read),)
            for g in shown:
                if len(g) < 2 or "\ufffd" in g or g.isascii():
                    continue
                if g in forms:
                    if n not in forms[g][0]:
                        forms[g] = ((*forms[g][0], n), forms[g][1])
                    continue
                # Two letters, or two hanzi in daily use, may stand side by side in proper text.
                inword = g[0] in "ÃÅ" and g[1] in "ŠŒŽšœžŸƒ"  # no writing has these side by side
                plain = written != "utf-8" or COMMON.issuperset(g) or LETTERS.issuperset(g) or any(x.isascii() and x.isalnum() for x in g)
                forms[g] = ((n,), inword or not plain)
    return forms


def automaton() -> ahocorasick.Automaton:
    """The automaton over all garbled forms, built once per Python worker."""
    cache = globals().setdefault("_AUTOMATON", [])
    if not cache:
        a = ahocorasick.Automaton()
        for g, (n, proof) in garbled_forms().items():
            a.add_word(g, (len(g), n, proof))
        for g in (*LOST, *CONTROLS):
            a.add_word(g, (len(g), (-1,), True))
        a.make_automaton()
        cache.append(a)
    return cache[0]


QUOTED = re.compile("|".join(f"{re.escape(a)}[^{re.escape(a + b)}\n]+{re.escape(b)}" for a, b in QUOTES.items()))
#: Matches in a row that count without proof.
ROW = 3


def runs_of(text: str) -> list[tuple[int, int, list[int], bool]]:
    """Maximal runs of matches outside short quotations: (start, end, pairs by votes, sure)."""
    if text.isascii() or not UNUSUAL.search(text):
        return []
    hits = sorted((e - v[0] + 1, e + 1, v[1], v[2]) for e, v in automaton().iter(text))
    if not hits:
        return []
    quoted = [m.span() for m in QUOTED.finditer(text)]
    if quoted:
        hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b in quoted)]
    if KANA_HALF.search(text):
        # Letters shown as half-width kana come in pairs; a word of such kana may have any length.
        words = [m.span() for m in HALF_WORD.finditer(text) if len(m.group()) % 2]
        hits = [(s, e, n, proof and not any(s < b and a < e for a, b in words)) for s, e, n, proof in hits]
    runs: list[list] = []
    for s, e, n, proof in hits:
        if runs and s <= runs[-1][1] + 1:
            run = runs[-1]
            run[1] = max(run[1], e)
            run[2] += n
            run[3] = run[3] or proof
            run[4] += 1
        else:
            runs.append([s, e, [*n], proof, 0])
    return [(s, e, sorted(set(ns), key=lambda n: (-ns.count(n), n)), proof or more + 1 >= ROW) for s, e, ns, proof, more in runs]


def undo(text: str, start: int, end: int, pair: int) -> tuple[int, int, str] | None:
    """The stretch about a run that the pair undoes, and what it was; None if it can't be.

    One-byte encodings stretch both ways over characters they can show; with
    two bytes a form starts the stretch and the first undecodable byte ends it.
    """
    written, read = PAIRS[pair]
    if read in BYTE_OF:
        shown = BYTE_OF[read]
        fits = lambda c: not c.isascii() and c in shown
        while start and fits(text[start - 1]):
            start -= 1
        while end < len(text) and fits(text[end]):
            end += 1
        try:
            data = unread(text[start:end], read)
        except UnicodeError:
            return None
        for skip in range(3):
            try:
                return start + skip, end, data[skip:].decode(written)
            except UnicodeDecodeError as x:
                if x.start > 1:
                    good = data[skip : skip + x.start].decode(written)
                    return start + skip, start + skip + x.start, good
        return None
    while end < len(text) and not text[end].isascii() and text[end] != "\ufffd":
        end += 1
    stop = min(len(text), end + 1)
    while stop > start:
        try:
            data = unread(text[start:stop], read)
        except UnicodeError as x:
            stop = start + getattr(x, "start", 0)
            continue
        try:
            good = data.decode(written)
        except UnicodeDecodeError as x:
            good = data[: x.start].decode(written)
            # Only whole characters of the shown text may go.
            stop = start
            for c in text[start : start + x.start]:
                if len(unread(text[start : stop + 1], read)) > x.start:
                    break
                stop += 1
            data = unread(text[start:stop], read)
            try:
                good = data.decode(written)
            except UnicodeDecodeError as y:
                stop -= 1
                if y.start == 0:
                    return None
                continue
        return (start, stop, good) if good else None
    return None


def likely(text: str) -> bool:
    """Whether restored text looks written: hardly anything in it is out of the usual."""
    return sum(1 for c in text if c not in COMMON and c not in LETTERS and not 0x2000 <= ord(c) < 0x2100) * 4 <= len(text)


#: Accented letters and signs of everyday writing, from the languages most texts are in.
EVERYDAY = frozenset("äöüßÄÖÜéèêëàâçîïôùûœæñáíóúãõåøÉÀÇ¿¡«»„“”‘’–—…€°·×→")


def usualness(text: str) -> float:
    """The share of characters in everyday use; what restored text is chosen by."""
    return sum(1 for c in text if c in COMMON or c in EVERYDAY) / max(1, len(text))


def shows(good: str, written: str, read: str, seen: str) -> bool:
    """Whether ``good``, written and read so, gives exactly what was seen."""
    try:
        return misread(good.encode(written), read) == seen
    except UnicodeError:
        return False


SCRIPT_LETTERS = {
    "cyrillic": re.compile("[а-яёА-ЯЁ]"),
    "hangul": re.compile("[가-힣]"),
    "kana": re.compile("[ぁ-んァ-ヶー]"),
    "hanzi": re.compile("[" + "".join(hanzi(16, 55)) + "]"),
}
#: Fixed value: the ten letters that Russian uses most; what tells two Cyrillic readings apart.
FREQUENT = "оеаинтсрвл"
#: A capital inside a Cyrillic word after a small letter: case as another Cyrillic code shows it.
FLIPPED = re.compile("[а-яё][А-ЯЁ]{2,}")
NON_ASCII = re.compile("[^\\x00-\\x7f]+(?:[ ,.!?;:-]{0,3}[^\\x00-\\x7f]+)*")
#: Trail bytes below 0x80 show as ASCII inside such spans.
WIDE_SPAN = re.compile("[^\\x00-\\x7f](?:[\\x20-\\x7e]?[^\\x00-\\x7f])*[\\x40-\\x7e]?")
KANA_HALF = re.compile("[｡-ﾟ]")
HALF_WORD = re.compile("[｡-ﾟ]+")
ORDINARY_HAN = COMMON | frozenset(c for lead in range(0xA4, 0xC7) for cell in (*range(0x40, 0x7F), *range(0xA1, 0xFF)) for c in bytes((lead, cell)).decode("big5", "ignore"))


def oddness(span: str) -> float:
    """How much of a span is out of the usual for any writing: accented letters in a row, symbols among letters, rare hanzi, flipped case."""
    odd = 0
    for before, c in zip("\0" + span, span):
        o = ord(c)
        if 0x80 <= o < 0x250:
            odd += 0x80 <= ord(before) < 0x250 or not c.isalpha()
        elif 0x4E00 <= o < 0xA000:
            odd += c not in ORDINARY_HAN
        elif 0x2500 <= o < 0x2600 or 0xE000 <= o < 0xF900 or 0xFF61 <= o < 0xFFA0 or 0x2200 <= o < 0x2300:
            odd += 1
    odd += sum(len(m.group()) for m in FLIPPED.finditer(span))
    return odd / max(1, len(span))


def written_share(text: str, script: str) -> float:
    """The share of a text's characters other than ASCII that are of the script (for kana, hanzi in daily use count too)."""
    rest = [c for c in text if not c.isascii()]
    if not rest:
        return 0.0
    letters = SCRIPT_LETTERS[script]
    marks = "，。、：；？！（）「」“”　—"
    own = sum(1 for c in rest if letters.fullmatch(c) or c in marks or (script == "kana" and (c in COMMON or c in ORDINARY_HAN)))
    if script == "kana" and not any(letters.fullmatch(c) for c in rest):
        return 0.0
    if script == "cyrillic" and FLIPPED.search(text):
        return 0.0
    return own / len(rest)


def pair_reading(span: str, written: str, read: str) -> tuple[float, str] | None:
    """(share of the script, text) if the pair turns the span back without a remainder into usual writing."""
    try:
        text = unread(span, read).decode(written)
    except UnicodeError:
        return None
    share = written_share(text, SCRIPTS[written])
    if share < 0.9 or oddness(text) > 0.05 or not shows(text, written, read, span):
        return None
    low = text.lower()
    usual = sum(low.count(c) for c in FREQUENT) / max(1, len(low)) if SCRIPTS[written] == "cyrillic" else 0.0
    return share + (0.05 if text[1:].islower() else 0.0) + usual, text


def whole_reading(span: str) -> tuple[str, bool, tuple[str, str]] | None:
    """What a span of whole odd characters was, whether that is certain, and the pair; None if no pair explains it.

    Certain is what one script alone explains.  Hangul in the rows of the
    Korean table read as hanzi, say, is told apart by a span that hanzi would
    not keep to those rows in.
    """
    found: dict[str, tuple[float, str, tuple[str, str]]] = {}
    for pair in WHOLE:
        back = pair_reading(span, *pair)
        script = SCRIPTS[pair[0]]
        # Two-byte characters make writing of almost any few bytes.
        if back and (script == "cyrillic" or len(span) >= 6) and (script not in found or back > found[script][:2]):
            found[script] = (*back, pair)
    if not found:
        return None
    if "hangul" in found and "hanzi" in found:
        # Chinese text leaves the 25 rows of hangul within a few characters.
        if len(SCRIPT_LETTERS["hangul"].findall(found["hangul"][1])) < 8:
            return found["hangul"][1], False, found["hangul"][2]
        found.pop("hanzi")
    share, text, pair = max(found.values())
    return text, len({f[1] for f in found.values()}) == 1, pair


def whole_spans(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, what it was, certain) of the spans that a pair of whole characters explains.

    A pair that is certain of one span also counts for the spans that are not
    odd by themselves, such as words in capitals.
    """
    quoted = [m.span() for m in QUOTED.finditer(text)]
    out: list[tuple[int, int, str, bool]] = []
    sure = set()
    spans = [m.span() for pattern in (NON_ASCII, WIDE_SPAN) for m in pattern.finditer(text)]
    spans = [(s, e) for s, e in spans if e - s >= 2 and not any(a <= s and e <= b for a, b in quoted)]
    for s, e in spans:
        span = text[s:e]
        odd = oddness(span)
        if e - s < 4 or odd < 0.5 and not FLIPPED.search(span) or any(s < b and a < e for a, b, _, _ in out):
            continue
        back = whole_reading(span)
        if back and (odd >= 0.5 or SCRIPTS[back[2][0]] == "cyrillic"):
            out.append((s, e, *back[:2]))
            if back[1]:
                sure.add(back[2])
    for s, e in spans if sure else ():
        if not any(s < b and a < e for a, b, _, _ in out):
            more = [b for p in sorted(sure) if (b := pair_reading(text[s:e], *p))]
            if more:
                out.append((s, e, max(more)[1], True))
    return sorted(out)


def repair(text: str | None) -> tuple[bool, bool, str | None]:
    """(garbled, fully restored, text with all restorable spans put back).

    What was garbled several times is undone as often; each time the text gets
    shorter or stays as it is, so this ends by itself.
    """
    if not text:
        return False, False, text
    garbled, doubt = False, False
    while True:
        runs = runs_of(text)
        sure = {n for _, _, ns, ok in runs if ok for n in ns}
        pieces, at, changed = [], 0, False
        if sure:
            garbled = True
            for s, e, ns, ok in runs:
                # A short run is believed where the same pair is sure elsewhere in the text.
                best, unclear = None, False
                for n in ns if s >= at else ():
                    if n < 0 or n not in sure:
                        continue
                    back = undo(text, s, e, n)
                    if not back or back[0] < at or back[1] <= back[0] or not shows(back[2], *PAIRS[n], text[back[0] : back[1]]):
                        continue
                    if not (PAIRS[n][0] == "utf-8" and PAIRS[n][1] in BYTE_OF or likely(back[2])):
                        continue
                    if PAIRS[n][0] != "utf-8":
                        whole = whole_reading(text[back[0] : back[1]])
                        if whole and whole[0] != back[2]:
                            # Another script explains the same bytes: its reading counts, or none if it is not certain.
                            if not whole[1]:
                                unclear = True
                                continue
                            back = (back[0], back[1], whole[0])
                    rank = (usualness(back[2]), back[1] - back[0], -ns.index(n))
                    if best is None or rank > best[0]:
                        best = (rank, back)
                doubt = doubt or (unclear and not best)
                if best:
                    back = best[1]
                    pieces += [text[at : back[0]], back[2]]
                    at, changed = back[1], True
        if not changed and not text.isascii() and UNUSUAL.search(text):
            for s, e, was, certain in whole_spans(text):
                garbled = True
                if certain:
                    pieces += [text[at:s], was]
                    at, changed = e, True
                else:
                    doubt = True
        if not changed:
            return garbled, garbled and not doubt and not sure and not any(x in text for x in LOST), text
        text = "".join(pieces) + text[at:]


def find_garbled(df: DataFrame, key: str, text: str, with_text: bool = True) -> DataFrame:
    """(key, garbled, restored, text): every row, its text with the matched spans put back.

    ``garbled`` tells whether the text shows characters of a wrong decoding
    anywhere but in a short quotation; ``restored`` whether all of it could be
    undone.  ``with_text`` false leaves the text null.  Null and empty texts are not garbled and come out as they are.
    Each row is judged by itself, so the plan has no shuffle.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [repair(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] if with_text else None for r in rows], pa.string())], names=["key", "garbled", "restored", "text"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, garbled boolean, restored boolean, text string").withColumnRenamed("key", key)
