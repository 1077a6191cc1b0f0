"""Noise in text from scanned pages: finding it and restoring continuous paragraphs.

Method: the lines that lie outside the text are taken away, the rest becomes
one character stream, and the least costly path through a lattice over that
stream says at once where words begin and end and what they were.  Its edges
are dictionary words, in Latin letters and in hanzi alike, matched character
by character; on the way a word may take a look-alike for its own character,
pass over a blank (a word split in two), over a line end, or over a hyphen
with a line end, and may follow another word without a blank (words run
together), each at a price.  Whatever no word explains is an unknown token or
a single character.  Paragraph ends are chosen by dynamic programming over the
former line ends.

Look-alikes are not listed but learned from all the texts: a character that
stands in a word's place much more often in scans than in other texts was
misread.  The words of running lines are learned in the same pass.  Running
lines are known by recurring in a file, so pages say which edge lines may be
one, the lines are counted per file, and only counts come back.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HYPHENS = "-¬\u00ad‐"
PAGE_NUMBER = re.compile(r"\s*(?:第\s*[\d零〇一二三四五六七八九十百千]+\s*页|[-·\[(—]\s*\d+\s*[-·\])—]|\d{1,4}|[Pp]age\s+\d+(?:\s+of\s+\d+)?|\d+\s*/\s*\d+)\s*")
LINE_END = re.compile(r"\r\n|\n|\r")
#: What the task calls the editors of a work, as it is printed.
EDITORS = re.compile("编写组|主编|编著|编者|[Ee]ditors?\\b")
LATIN = re.compile(r"[A-Za-z0-9]+")
HAN = re.compile("[一-鿿]+")
#: A token of Latin letters, which a hyphen may break over a line end.
TOKEN = re.compile(rf"[A-Za-z0-9]+(?:(?<=[A-Za-z])[{HYPHENS}] *\n *[a-z0-9]+)*")
BREAK = re.compile(rf"[{HYPHENS}] *\n *")
#: A line end between hanzi.
HAN_BREAK = re.compile("(?<=[一-鿿])\n+(?=[一-鿿])")
BLANKS = re.compile("[ \n]+")
#: How many lines at either end of a page may lie outside the text.
EDGE = 2


@dataclass
class Knowledge:
    """What the decoder goes by: words, and what is shown for a character: shown -> the true ones."""

    words: list[str]
    shown: dict[str, list[str]] = field(default_factory=dict)


class Decoder:
    """The word lattice over a dictionary; costs are parameters."""

    #: Costs of a word, a look-alike in it, a blank in it, a hyphen over a line end, a word that follows without a blank.
    WORD, SLIP, SPLIT, HYPHEN, MERGE = 1.0, 1.2, 1.2, 0.2, 1.5
    #: Costs of a character by itself, of one that may be a look-alike, and of a hyphen kept over a line end.
    SINGLE, ODD, KEPT = 1.2, 2.1, 1.0

    def __init__(self, knowledge: Knowledge):
        self.words = {w.strip().lower() for w in knowledge.words if w and w.strip()}
        self.trie: dict = {}
        for w in sorted(self.words):
            if len(w) > 1 or w.isascii():
                node = self.trie
                for c in w:
                    node = node.setdefault(c, {})
                node[""] = w
        self.shown = {seen: sorted(true) for seen, true in knowledge.shown.items()}
        self.longest_shown = max(map(len, self.shown), default=1)
        true_han = {c for w in self.words for c in w}
        self.odd_set = {s for s, ts in self.shown.items() if HAN.fullmatch(s) and any(t in true_han for t in ts)}
        self.odd = re.compile("[" + "".join(map(re.escape, sorted(self.odd_set))) + "]") if self.odd_set else re.compile(r"(?!)")
        # Only what is made of the characters of words can be one: a run of them is decoded by itself.
        inner = "".join(map(re.escape, sorted(c for c in true_han | self.odd_set if HAN.fullmatch(c)))) or "\0"
        self.run = re.compile(f"[{inner}](?:[ \n]*[{inner}])*")
        latin = [w for w in self.words if w.isascii()]
        self.starts = {v for w in latin for n in (1, 2, 3) for v in self.spellings(w[:n])}
        self.finishes = {v for w in latin for n in (1, 2, 3) for v in self.spellings(w[-n:])}

    def spellings(self, part: str) -> set[str]:
        """How a part of a word may be shown, cut to three characters."""
        out = {part}
        for seen, true in self.shown.items():
            for t in true:
                out |= {v.replace(t, seen) for v in list(out) if t in v}
        return {v[:3] for v in out} | {v[-3:] for v in out}

    def edges(self, text: str, at: int) -> list[tuple[int, float, str, int, int]]:
        """(end, cost, word, look-alikes, hyphens) of every dictionary word that ``text`` may show at ``at``."""
        found: dict[tuple[int, str], tuple[float, int, int]] = {}
        stack = [(at, self.trie, self.WORD, 0, 0, "")]
        size = len(text)
        while stack:
            i, node, cost, slips, hyphens, last = stack.pop()
            if "" in node and i > at:
                key = (i, node[""])
                if key not in found or cost < found[key][0]:
                    found[key] = (cost, slips, hyphens)
            if i >= size:
                continue
            c = text[i].lower()
            if c in node:
                stack.append((i + 1, node[c], cost, slips, hyphens, c))
            for n in range(1, min(self.longest_shown, size - i) + 1):
                for true in self.shown.get(text[i : i + n].lower(), ()):
                    below = node
                    for t in true:
                        below = below.get(t)
                        if below is None:
                            break
                    if below is not None:
                        stack.append((i + n, below, cost + self.SLIP, slips + 1, hyphens, true))
            if i > at and last:
                if c in " \n":
                    blanks = BLANKS.match(text, i).group()
                    if "\n" not in blanks or not last.isascii():
                        stack.append((i + len(blanks), node, cost + self.SPLIT * (" " in blanks), slips, hyphens, ""))
                elif c in HYPHENS and last.isascii():
                    m = BREAK.match(text, i)
                    if m:
                        stack.append((m.end(), node, cost + self.HYPHEN, slips, hyphens + 1, ""))
        return [(end, cost, word, slips, hyphens) for (end, word), (cost, slips, hyphens) in found.items()]

    @staticmethod
    def _path(back: list, at: int) -> tuple[str, int, int]:
        parts, slips, hyphens = [], 0, 0
        while at:
            before, shown, s, h = back[at]
            parts.append(shown)
            slips += s
            hyphens += h
            at = before
        return "".join(reversed(parts)), slips, hyphens

    def decode_han(self, run: str) -> tuple[str, int, int]:
        """The least costly reading of a run of hanzi."""
        n = len(run)
        cost, back = [0.0] + [1e9] * n, [(0, "", 0, 0)] * (n + 1)
        for i in range(n):
            if cost[i] >= 1e9:
                continue
            c = run[i]
            price = 0.0 if c in " \n" else self.ODD if c in self.odd_set else self.SINGLE
            if cost[i] + price < cost[i + 1]:
                cost[i + 1], back[i + 1] = cost[i] + price, (i, "" if c == "\n" else c, 0, 0)
            if c in self.trie or c in self.shown:
                for j, price, word, slips, _ in self.edges(run, i):
                    if cost[i] + price < cost[j]:
                        cost[j], back[j] = cost[i] + price, (i, word, slips, 0)
        return self._path(back, n)

    def cased(self, word: str, shown: str, slips: int, before: str) -> str:
        """A word as it stood: its own letters where none was misread, else in the case of its beginning."""
        bare = BREAK.sub("", shown).replace(" ", "")
        if not slips:
            return bare
        if shown[0].isupper() or (shown[0].isdigit() and before[-2:] in (". ", "? ")):
            return word.capitalize()
        return word

    def decode_latin(self, text: str, start: int, stop: int) -> tuple[str, int, int]:
        """The least costly reading of ``text[start:stop]``, which begins and ends with whole tokens."""
        part = text[start:stop]
        n = len(part)
        ends = {}
        for m in TOKEN.finditer(part):
            ends[m.start()] = m.end()
        inside = [False] * (n + 1)
        for s, e in ends.items():
            for i in range(s + 1, e):
                inside[i] = True
        cost, back = [0.0] + [1e9] * n, [(0, "", 0, 0)] * (n + 1)
        word_end = [False] * (n + 1)
        for i in range(n):
            if cost[i] >= 1e9:
                continue
            if inside[i] and not word_end[i]:
                continue
            options = []
            if i in ends:
                whole = part[i : ends[i]]
                breaks = len(BREAK.findall(whole))
                bare = BREAK.sub("", whole)
                options.append((ends[i], self.SINGLE * len(bare) + self.HYPHEN * breaks, bare, 0, breaks, False))
                if breaks:
                    first = BREAK.search(whole)
                    head = whole[: first.start()]
                    # Two words of which the hyphen is part: only where the first is one.
                    if head.lower() in self.words and whole[first.end() :].lower() in self.words:
                        options.append((ends[i], 2 * self.WORD + self.KEPT, head + "-" + whole[first.end() :], 0, 0, False))
            elif not inside[i]:
                options.append((i + 1, 0.0, part[i], 0, 0, False))
            if i in ends or inside[i]:
                extra = self.MERGE if inside[i] else 0.0
                for j, price, word, slips, hyphens in self.edges(part, i):
                    if (inside[i] or inside[j]) and not part[i:j].islower():
                        continue
                    shown = self.cased(word, part[i:j], slips, text[:start] + part[:i] if slips else "")
                    options.append((j, price + extra, (" " if inside[i] else "") + shown, slips, hyphens, inside[j]))
            for j, price, shown, slips, hyphens, goes_on in options:
                if cost[i] + price < cost[j]:
                    cost[j], back[j], word_end[j] = cost[i] + price, (i, shown, slips, hyphens), goes_on
        return self._path(back, n)

    def doubtful(self, token: str) -> bool:
        """Whether a token that is no word may be part of one, or hold one."""
        low = token.lower()
        return not low.isdigit() and (low[:3] in self.starts or low[-3:] in self.finishes)

    def decode(self, stream: str) -> tuple[str, int, int]:
        """A stream of lines put right; how many words in it were misread, how many broken over a line end."""
        slips = hyphens = 0

        def han(m: re.Match) -> str:
            nonlocal slips
            run = m.group()
            if " " not in run and not self.odd.search(run):
                return run
            shown, n, _ = self.decode_han(run)
            slips += n
            return shown

        stream = HAN_BREAK.sub("", self.run.sub(han, stream))
        out, at = [], 0
        tokens = list(TOKEN.finditer(stream))
        for k, m in enumerate(tokens):
            t = m.group()
            if m.start() < at or (t.lower() in self.words) or not ("\n" in t or self.doubtful(t)):
                continue
            # A word split in two may begin in the token before or end in the one after.
            first, last = m, m
            if k and tokens[k - 1].start() >= at and not stream[tokens[k - 1].end() : m.start()].strip(" "):
                first = tokens[k - 1]
            if k + 1 < len(tokens) and not stream[m.end() : tokens[k + 1].start()].strip(" "):
                last = tokens[k + 1]
            shown, n, h = self.decode_latin(stream, first.start(), last.end())
            slips += n
            hyphens += h
            out += [stream[at : first.start()], shown]
            at = last.end()
        out.append(stream[at:])
        return joined("".join(out)), slips, hyphens


def joined(stream: str) -> str:
    """The line ends that are left: a blank between Latin words, else nothing."""
    lines = [x.strip() for x in stream.split("\n")]
    out = ""
    for line in (x for x in lines if x):
        latin = out and out[-1].isascii() and line[0].isascii() and not (out[-1] == "." and line[0].islower())
        out += (" " if latin else "") + line
    return out


def stream_of(lines) -> str:
    """Lines as one stream, in which their ends are what is left of them."""
    return "\n".join(b for b in (x.strip() for x in lines) if b)


SENTENCE_END = re.compile(r"[。！？.!?:：；;）)”\"]$")


def paragraphs(lines: list[str]) -> list[list[str]]:
    """The lines in paragraphs, by the least sum of costs over all choices of paragraph ends.

    A paragraph costs a constant; ending it inside a sentence costs more, and
    so does ending it on a line as long as the longest, or keeping a line that
    is much shorter than the others inside.
    """
    lines = [x for x in lines if x.strip()]
    if not lines:
        return []
    width = max(len(x.strip()) for x in lines)

    def end_cost(line: str) -> float:
        bare = line.strip()
        return 1.0 + (0.0 if SENTENCE_END.search(bare) else 4.0) + 2.0 * (len(bare) / width > 0.8)

    def inner_cost(line: str) -> float:
        bare = line.strip()
        return 3.5 if SENTENCE_END.search(bare) and len(bare) / width < 0.6 else 0.0

    n = len(lines)
    # keep: the cost if the paragraph goes on after line i; stop: if it ends there.
    keep, stop, choice = 0.0, 0.0, []
    for i, line in enumerate(lines[:-1]):
        least = min(keep, stop) if i else 0.0
        keep, stop = least + inner_cost(line), least + end_cost(line)
        choice.append(stop < keep)
    out, at = [], 0
    for i in range(n - 1):
        if choice[i]:
            out.append(lines[at : i + 1])
            at = i + 1
    out.append(lines[at:])
    return out


def page_lines(text: str) -> tuple[list[str], list[int], list[int]]:
    """Lines, the numbers of page-number lines, and of the edge lines that may be running ones."""
    lines = LINE_END.split(text)
    numbers = [i for i, x in enumerate(lines) if PAGE_NUMBER.fullmatch(x)]
    taken = set(numbers)
    rest = [i for i, x in enumerate(lines) if x.strip() and i not in taken]
    if not rest:
        # Nothing but a number is no page with a number on it.
        return lines, [], []
    edge = sorted({*rest[:EDGE], *rest[-EDGE:]})
    return lines, numbers, edge


def bare_line(line: str) -> str:
    """A line without outer blanks and the page number at either end."""
    return re.sub(r"\s+", " ", re.sub(r"^\s*\d{1,4}\s+(?=\D)|[\s·|]+\d{1,4}\s*$", "", line)).strip()


def scan_items(df: DataFrame, key: Column, text: Column, file: Column, work: Column, kind: str, is_scan: Column) -> DataFrame:
    """(item_kind, item_key, file, work, text, scan) of the rows that have a text; those that are no scans teach what is usual."""
    picked = df.where(text.isNotNull() & (F.length(text) > 0))
    return picked.select(F.lit(kind).alias("item_kind"), key.cast("string").alias("item_key"), file.cast("string").alias("file"), work.cast("string").alias("work"), text.cast("string").alias("text"), F.coalesce(is_scan, F.lit(False)).alias("scan"))


# ------------------------------------------------------------------ learning


class Blanks:
    """The words of a dictionary with one place left open, to see what stands there in texts."""

    #: Latin words shorter than this say too little with a letter left open.
    SHORTEST = 4

    def __init__(self, dictionary: list[str]):
        words = sorted({d.strip().lower() for d in dictionary if d and d.strip()})
        self.latin = {w for w in words if LATIN.fullmatch(w)}
        #: A word with an open place to what stands there.
        self.one: dict[str, list[str]] = defaultdict(list)
        for w in sorted(self.latin):
            if len(w) >= self.SHORTEST:
                for i in range(len(w)):
                    self.one[f"{w[:i]}*{w[i + 1 :]}"].append(w[i])
                    if i + 1 < len(w) and len(w) > self.SHORTEST:
                        self.one[f"{w[:i]}**{w[i + 2 :]}"].append(w[i : i + 2])
        han = [w for w in words if len(w) > 1 and HAN.fullmatch(w)]
        self.lengths = sorted({len(w) for w in han})
        rng = np.random.Generator(np.random.PCG64(11))
        self.factor = rng.integers(1, 2**63, max(self.lengths, default=1), dtype=np.uint64) | np.uint64(1)
        self.exact: dict[int, np.ndarray] = {}
        self.open: dict[tuple[int, int], set[int]] = {}
        self.table: dict[tuple[int, int], np.ndarray] = {}
        for n in self.lengths:
            of_length = [w for w in han if len(w) == n]
            self.exact[n] = np.zeros(2**16, bool)
            for w in of_length:
                self.exact[n][self._hash(w, None) >> 48] = True
            self.known = set(han)
            for k in range(n):
                known = self.open[n, k] = set()
                table = self.table[n, k] = np.zeros(2**16, bool)
                for w in of_length:
                    known.add(self._hash(w, k))
                    self.one[f"{w[:k]}*{w[k + 1 :]}"].append(w[k])
                    table[self._hash(w, k) >> 48] = True

    def _hash(self, word: str, but: int | None) -> int:
        return sum(ord(c) * int(self.factor[j]) for j, c in enumerate(word) if j != but) % 2**64

    def hanzi(self, text: str) -> tuple[Counter, int]:
        """How often each character stands in the open place of each word: (word with *, seen); and the number of whole words."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        covered = np.zeros(len(points), bool)
        whole = 0
        hashes = {}
        for n in self.lengths:
            if len(points) < n:
                continue
            m = len(points) - n + 1
            parts = [points[j : j + m] * self.factor[j] for j in range(n)]
            total = parts[0].copy()
            for x in parts[1:]:
                total += x
            hashes[n] = (total, parts)
            for i in np.flatnonzero(self.exact[n][total >> np.uint64(48)]).tolist():
                if text[i : i + n] in self.known:
                    covered[i : i + n] = True
                    whole += 1
        pairs: Counter = Counter()
        # Longer words first: what belongs to one with an open place says nothing of a shorter one.
        for n, (total, parts) in sorted(hashes.items(), reverse=True):
            inside = []
            for k in range(n):
                rest = total - parts[k]
                hit = self.table[n, k][rest >> np.uint64(48)] & ~covered[k : k + len(rest)]
                for i in np.flatnonzero(hit).tolist():
                    seen = text[i + k]
                    if int(rest[i]) in self.open[n, k] and HAN.fullmatch(seen):
                        pattern = f"{text[i : i + k]}*{text[i + k + 1 : i + n]}"
                        if pattern in self.one:
                            pairs[pattern, seen] += 1
                            inside += range(i, i + n)
            covered[inside] = True
        return pairs, whole

    def letters(self, text: str) -> tuple[Counter, int]:
        """The same for Latin words, where one letter may be shown as two and two as one."""
        pairs: Counter = Counter()
        whole = 0
        for t, n in Counter(LATIN.findall(text.lower())).items():
            if t in self.latin:
                whole += n
                continue
            if t.isdigit() or len(t) < self.SHORTEST - 1:
                continue
            for i in range(len(t)):
                for pattern, seen in ((f"{t[:i]}*{t[i + 1 :]}", t[i]), (f"{t[:i]}*{t[i + 2 :]}", t[i : i + 2]), (f"{t[:i]}**{t[i + 1 :]}", t[i])):
                    if pattern in self.one:
                        pairs[pattern, seen] += n
        return pairs, whole


EVIDENCE = "what string, a string, b string, scan boolean, n bigint"


def scan_evidence(items: DataFrame, dictionary: list[str]) -> DataFrame:
    """(what, a, b, scan, n): counts of what stands in words (han, latin), of whole words, and of words beside the title in edge lines.

    Each batch counts for itself, so what is shuffled are distinct counts.
    """
    shared = items.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = None
        for batch in batches:
            tool = tool or Blanks(shared.value)
            counts: Counter = Counter()
            flags = batch.column(2).to_pylist()
            texts = batch.column(1).to_pylist()
            kept: dict[bool, list[str]] = {False: [], True: []}
            for work, text, file, scan in zip(batch.column(0).to_pylist(), texts, batch.column(3).to_pylist(), flags):
                if not scan:
                    kept[False].append(text)
                    continue
                title = bare_line(work or "")
                lines, numbers, edge = page_lines(text)
                away = set(numbers)
                for i in edge:
                    line = bare_line(lines[i])
                    if title and title in line:
                        away.add(i)
                        for word in HAN.findall(line.replace(title, " ")):
                            if len(word) > 1 and file is not None:
                                counts["edge", word, file, True] += 1
                # Lines outside the text and broken words would speak against the scans without being misread.
                kept[True].append(BREAK.sub("", stream_of(x for i, x in enumerate(lines) if i not in away)))
            for scan, chosen in kept.items():
                if not chosen:
                    continue
                plain = "\0".join(chosen)
                for what, (pairs, whole) in (("han", tool.hanzi(re.sub("[ \\r\\n]+", "", plain))), ("latin", tool.letters(plain))):
                    for (a, b), n in pairs.items():
                        counts[what, a, b, scan] += n
                    counts[what, "", "", scan] += whole
            if counts:
                keys = list(zip(*counts))
                yield pa.RecordBatch.from_arrays([*(pa.array(k, pa.string()) for k in keys[:3]), pa.array(keys[3], pa.bool_()), pa.array(list(counts.values()), pa.int64())], names=["what", "a", "b", "scan", "n"])

    rows = items.select("work", "text", "scan", "file").mapInArrow(run, EVIDENCE)
    return rows.groupBy("what", "a", "b", "scan").agg(F.sum("n").alias("n"))


def learn(items: DataFrame, dictionary: list[str], scratch, least: int = 5, rate: float = 1e-5, contrast: float = 5.0, fraction: float = 0.1, files: int = 3, most: int = 100_000) -> Knowledge:
    """What the decoder needs to know, from all texts.

    What stands in a word's open place counts if it does so ``contrast`` times
    as often in scans as in other texts, a word.  It is taken for a look-alike
    of a character if at least ``least`` such places, and ``rate`` of all words
    in scans, speak for that, each place for one of the characters it may be: the one that most others speak for;
    a further one needs at least ``fraction`` of what the first one has.
    A word beside the title in edge lines of ``files`` files or more is one of
    running lines, unless it is a misreading of a commoner one.  Both lists
    are checked to be no longer than ``most`` before they are collected; they
    grow with alphabets and vocabulary, not with the texts.
    """
    counts = scratch.write(scan_evidence(items, dictionary), "evidence")
    totals = {(r.what, r.scan): r.n for r in counts.where("a = '' AND b = ''").collect()}
    share = {what: (totals.get((what, False), 0) + 1) / (totals.get((what, True), 0) + 1) for what in ("han", "latin")}
    places = counts.where("what IN ('han', 'latin') AND a <> ''").groupBy("what", "a", "b").agg(F.sum(F.when(F.col("scan"), F.col("n")).otherwise(0)).alias("seen"), F.sum(F.when(~F.col("scan"), F.col("n")).otherwise(0)).alias("clean"))
    usual = F.when(F.col("what") == "han", F.lit(share["han"])).otherwise(F.lit(share["latin"]))
    places = places.where((F.col("seen") > 0) & (F.col("seen") * usual >= contrast * F.col("clean"))).select("what", "a", "b", "seen")
    words = counts.where("what = 'edge'").groupBy("a").agg(F.count("*").alias("files"), F.sum("n").alias("n")).where(F.col("files") >= files)
    found = [df.limit(most + 1).collect() for df in (places, words)]
    if max(map(len, found)) > most:
        raise ValueError(f"more than {most} look-alikes or words of running lines can't be shipped to every task")
    may_be = Blanks(dictionary).one
    at: dict[tuple[str, str], dict[str, int]] = defaultdict(dict)
    for r in sorted(found[0]):
        at[r.what, r.b][r.a] = r.seen
    shown: dict[str, list[str]] = defaultdict(list)
    for (what, seen), places in sorted(at.items()):
        left, first = dict(places), 0
        while left:
            votes: Counter = Counter()
            for pattern, n in left.items():
                for true in sorted(set(may_be[pattern])):
                    votes[true] += n
            true, n = min(votes.items(), key=lambda v: (-v[1], v[0]))
            first = first or n
            if n < max(least, rate * totals.get((what, True), 0)) or n * share[what] < contrast or n < fraction * first:
                break
            shown[seen].append(true)
            left = {p: k for p, k in left.items() if true not in may_be[p]}
    known = {r.a: r.n for r in found[1]}
    misread = lambda w: any(known.get(w[:i] + t + w[i + 1 :], 0) > known[w] for i, c in enumerate(w) for t in shown.get(c, ()))
    return Knowledge(sorted({*dictionary, *(w for w in known if not misread(w))}), dict(shown))


def inspect_scans(items: DataFrame, knowledge: Knowledge) -> DataFrame:
    """(item_kind, item_key, file, noise, candidates): what a page shows by itself.

    ``noise`` lists hyphen, misread and pageno; ``candidates`` are the edge
    lines (number, repaired line, whether it names the work or its editors).
    """
    shared = items.sparkSession.sparkContext.broadcast(knowledge)
    candidate = pa.struct([("no", pa.int32()), ("line", pa.string()), ("names", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = None
        for batch in batches:
            tool = tool or Decoder(shared.value)
            noise, found = [], []
            for work, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                lines, numbers, edge = page_lines(text)
                kinds = ["pageno"] if numbers else []
                out, named, slips = [], set(), 0
                title = bare_line(work or "")
                for i in edge:
                    line, n, _ = tool.decode(bare_line(lines[i]))
                    names = bool(title and title in line and len(line) <= 3 * len(title)) or bool(EDITORS.search(line))
                    out.append({"no": i, "line": line, "names": names})
                    if names:
                        named.add(i)
                        slips += n
                taken = named.union(numbers)
                _, n, broken = tool.decode(stream_of(x for i, x in enumerate(lines) if i not in taken))
                if broken:
                    kinds.append("hyphen")
                if slips + n:
                    kinds.append("misread")
                noise.append(kinds)
                found.append(out)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(noise, pa.list_(pa.string())), pa.array(found, pa.list_(candidate))], names=["item_kind", "item_key", "file", "noise", "candidates"])

    return items.where("scan").mapInArrow(run, "item_kind string, item_key string, file string, noise array<string>, candidates array<struct<no:int,line:string,names:boolean>>")


def running_lines(inspected: DataFrame) -> DataFrame:
    """(file, line): edge lines of two different pages or more of a file, of which one names the work or editors.

    Two pages differ if the least and the greatest page key with the line do,
    so pages delivered twice count once and a file with a third of all pages
    costs its map-side partials only.
    """
    rows = inspected.where("file IS NOT NULL").select("file", F.concat_ws(":", "item_kind", "item_key").alias("page"), F.inline("candidates"))
    counted = rows.groupBy("file", "line").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.max("names").alias("names"))
    return counted.where((F.col("first") < F.col("last")) & F.col("names")).select("file", "line")


def scan_noise(items: DataFrame, dictionary: list[str], scratch, knowledge: Knowledge | None = None) -> DataFrame:
    """(item_kind, item_key, noise): each kind of noise of each page, once.

    Pages without noise, without text or with nothing but a page number give
    no row.  ``scratch`` holds the inspected pages between the two readings;
    ``knowledge`` is learned from the items if it isn't given.
    """
    inspected = scratch.write(inspect_scans(items, knowledge or learn(items, dictionary, scratch)), "inspected")
    own = inspected.select("item_kind", "item_key", F.explode("noise").alias("noise"))
    edges = inspected.where("file IS NOT NULL").select("item_kind", "item_key", "file", F.inline("candidates")).select("item_kind", "item_key", "file", "line")
    running = edges.join(running_lines(inspected), ["file", "line"], "left_semi").select("item_kind", "item_key", F.lit("running").alias("noise"))
    return own.unionByName(running).distinct()


def repair_scans(items: DataFrame, dictionary: list[str], scratch, knowledge: Knowledge | None = None) -> DataFrame:
    """(item_kind, item_key, n_paragraphs, text): continuous, correctly spelled paragraphs of every scanned page."""
    knowledge = knowledge or learn(items, dictionary, scratch)
    inspected = scratch.write(inspect_scans(items, knowledge), "inspected")
    edges = inspected.where("file IS NOT NULL").select("item_kind", "item_key", "file", F.inline("candidates"))
    outside = edges.join(running_lines(inspected), ["file", "line"], "left_semi").groupBy("item_kind", "item_key").agg(F.collect_set("no").alias("outside"))
    pages = items.where("scan").dropDuplicates(["item_kind", "item_key"]).join(outside, ["item_kind", "item_key"], "left").select("item_kind", "item_key", "text", "outside")
    shared = items.sparkSession.sparkContext.broadcast(knowledge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = None
        for batch in batches:
            tool = tool or Decoder(shared.value)
            texts, counts = [], []
            for text, away in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines, numbers, _ = page_lines(text)
                taken = {*numbers, *(away or ())}
                blocks = paragraphs([x for i, x in enumerate(lines) if i not in taken])
                texts.append("\n\n".join(tool.decode(stream_of(b))[0] for b in blocks))
                counts.append(len(blocks))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts, pa.int32()), pa.array(texts, pa.string())], names=["item_kind", "item_key", "n_paragraphs", "text"])

    return pages.mapInArrow(run, "item_kind string, item_key string, n_paragraphs int, text string")


def word_list(dictionary: DataFrame, most: int = 100_000) -> list[str]:
    """The dictionary's terms, sorted; its size is checked, as every task gets it."""
    rows = dictionary.where("term IS NOT NULL").select("term").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} words can't be shipped to every task")
    return sorted(r.term for r in rows)
