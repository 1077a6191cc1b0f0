"""Mapping free-entered values to a canonical list.

Method: names and aliases of the list go into a multi-pattern automaton that
finds them inside the values; mentions do not overlap and the longest wins.
What is left goes to token-set similarity: words are compared as sets, and
words that no dictionary knows may lie an edit away from the entry's words.

Traditional characters are folded by the table that Spark's own ICU library
holds.  Words that only embellish a name are learned: they stand beside
mentions of many different entries.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
WORD = re.compile(r"[a-z0-9]+|[^\Wa-z0-9_]+")


def simplified_forms(spark: SparkSession) -> dict[int, str]:
    """Traditional characters to simplified ones, from the public table of the ICU library."""
    every = "".join(map(chr, range(0x4E00, 0xA000)))
    folded = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified").transliterate(every)
    return {ord(a): b for a, b in zip(every, folded) if a != b} if len(folded) == len(every) else {}


def words_of(value: str, variants: dict[int, str] | None = None) -> list[str]:
    """Lower-case words of a value, free of width, case, spelling of blanks and the variants of characters."""
    value = unicodedata.normalize("NFKC", value)
    value = "".join(c for c in value if unicodedata.category(c) not in ("Cf", "Mn", "Cc") or c in "\t\n\r")
    value = CAMEL.sub(" ", value) if value.upper() != value else value
    return WORD.findall(value.lower().translate(variants or {}))


def osa(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two strings, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
        if min(row) > most:
            return most + 1
    return row[-1]


class CanonicalList:
    """The list in searchable form; ``dictionary`` holds words that are spelled right."""

    def __init__(self, entries: list[tuple[str, str, list[str]]], dictionary: list[str], variants: dict[int, str] | None = None, fillers: frozenset[str] = frozenset()):
        self.variants, self.fillers = variants or {}, fillers
        words_of = lambda v: globals()["words_of"](v, self.variants)
        self.known = {w for d in dictionary for w in words_of(d)}
        self.forms: dict[str, str] = {}
        self.sets: dict[frozenset, str] = {}
        for id, name, aliases in entries:
            for value in [name, *(aliases or [])]:
                words = words_of(value or "")
                whole = "".join(words)
                if len(whole) < 2:
                    continue
                self.forms[whole] = min(id, self.forms.get(whole, id))
        han = sorted((w for w in self.known if not w.isascii()), key=lambda w: (-len(w), w))
        self.segment = re.compile("|".join(map(re.escape, han)) or r"(?!)")
        self.automaton = ahocorasick.Automaton()
        self.grams: dict[str, list[str]] = defaultdict(list)
        self.parts: dict[str, list[str]] = {}
        for id, name, aliases in entries:
            for value in [name, *(aliases or [])]:
                words = words_of(value or "")
                whole = "".join(words)
                if self.forms.get(whole) != id:
                    continue
                tokens = self.tokens(words)
                self.automaton.add_word(whole, whole)
                self.parts[whole] = tokens
                if len(tokens) > 1:
                    key = frozenset(Counter(tokens).items())
                    self.sets[key] = min(id, self.sets.get(key, id))
                for g in self.gram_set(whole):
                    self.grams[g].append(whole)
        self.automaton.make_automaton()
        self.entry_words = {t for ts in self.parts.values() for t in ts}
        self.answers: dict[str, str] = {}

    def tokens(self, words: list[str]) -> list[str]:
        """Words, those of hanzi cut along the dictionary; what lies between stays as it is."""
        out: list[str] = []
        for w in words:
            if w.isascii():
                out.append(w)
                continue
            at = 0
            for m in self.segment.finditer(w):
                if m.start() > at:
                    out.append(w[at : m.start()])
                out.append(m.group())
                at = m.end()
            if at < len(w):
                out.append(w[at:])
        return out

    @staticmethod
    def gram_set(whole: str) -> set[str]:
        n = 3 if whole.isascii() else 1
        return {whole[i : i + n] for i in range(len(whole) - n + 1)}

    def mentions(self, words: list[str]) -> list[tuple[int, int, str]]:
        """(start, end, form) of the mentions in the words run together: the longest first, none overlapping another.

        A mention that begins or ends in Latin letters or digits does so where a word does.
        """
        whole = "".join(words)
        edges, at = {0}, 0
        for w in words:
            at += len(w)
            edges.add(at)
        found = []
        for end, form in self.automaton.iter(whole) if len(self.automaton) else ():
            start, end = end - len(form) + 1, end + 1
            if (start in edges or not form[0].isascii()) and (end in edges or not form[-1].isascii()):
                found.append((start, end, form))
        chosen: list[tuple[int, int, str]] = []
        for start, end, form in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            if all(end <= s or e <= start for s, e, _ in chosen):
                chosen.append((start, end, form))
        return chosen

    def strangers(self, value: str) -> list[tuple[str, str]]:
        """Pairs of a Latin word that neither list nor dictionary holds and an entry's word in the same value."""
        words = [w for w in words_of(value, self.variants) if w.isascii() and w.isalpha()]
        strange = [w for w in words if w not in self.known and w not in self.entry_words]
        return [(w, own) for w in strange for own in words if own in self.entry_words]

    def similar(self, words: list[str]) -> tuple[int, set[str]] | None:
        """(edits, ids): the entries whose set of words this is, save for misspelled words."""
        tokens = [t for t in self.tokens(words) if t not in self.fillers]
        key = frozenset(Counter(tokens).items())
        if key in self.sets:
            return 0, {self.sets[key]}
        stems = frozenset(Counter(t[:-1] if t.isascii() and t.endswith("s") and (t not in self.known or t[:-1] in self.entry_words) else t for t in tokens).items())
        if stems in self.sets:
            return 0, {self.sets[stems]}
        whole = "".join(tokens)
        grams = self.gram_set(whole)
        shared = Counter(f for g in grams for f in self.grams.get(g, ()))
        ascii_ = whole.isascii()
        best: list[tuple[int, str]] = []
        for form, n in shared.items():
            most = max(1, min(4, len(form) // 7)) if ascii_ else (1 if len(form) > 3 else 0)
            # Each edit costs as many grams as lie over it at most; more than a third (or a half) may not differ.
            if n < min(max(2, len(grams) // 3 if ascii_ else (len(grams) + 1) // 2), max(1, len(grams) - most * (4 if ascii_ else 2))):
                continue
            d = osa(whole, form, most)
            if d > most:
                # Words in another order: each is set against the entry's words by itself.
                d = self.soft_set(tokens, self.parts[form], most)
            if d <= most and not self.contradicts(tokens, self.parts[form], form):
                best.append((d, self.forms[form]))
        if not best:
            return None
        least = min(best)[0]
        return least, {i for d, i in best if d == least}

    @staticmethod
    def soft_set(tokens: list[str], parts: list[str], most: int) -> int:
        """Edits that make the words the entry's set, each word paired with the nearest one left."""
        if len(tokens) != len(parts):
            return most + 1
        left, total = list(parts), 0
        for t in sorted(tokens, key=lambda t: (t not in parts, t)):
            d, p = min((osa(t, p, most), p) for p in left)
            total += d
            left.remove(p)
            if total > most:
                return most + 1
        return total

    def contradicts(self, tokens: list[str], parts: list[str], form: str) -> bool:
        """Whether the value is rightly spelled and just says something else."""
        strange = [t for t in tokens if t not in self.known and t not in parts]
        if not strange:
            return True
        # Whole dictionary words that the entry lacks mean something else, unless they came about by a slip inside hanzi.
        return any(t.isascii() and len(t) > 3 and t in self.known and t not in form for t in tokens)

    def candidates(self, value: str) -> tuple[int, int, int, str, str] | None:
        """(way, score, place, least id, greatest id) of the best entries for a value, smaller is better: mentions, equal sets of words, like sets."""
        words = words_of(value, self.variants)
        if not words:
            return None
        chosen = self.mentions(words)
        if chosen:
            start, end, form = chosen[0]
            return 0, start - end, start, self.forms[form], self.forms[form]
        near = self.similar(words)
        return (2 if near[0] else 1, near[0], 0, min(near[1]), max(near[1])) if near else None

    def remembered(self, value: str) -> tuple[int, int, int, str, str] | None:
        if value not in self.answers:
            if len(self.answers) > 200_000:
                self.answers.clear()
            self.answers[value] = self.candidates(value)
        return self.answers[value]

    def lookup(self, value: str) -> str:
        """The id of the entry that the value means, or the empty string."""
        return decided([self.candidates(value)])


def decided(candidates: list) -> str:
    """The id that the candidates of all shards of a list come to; empty if none or if equally near ones differ."""
    found = [c for c in candidates if c]
    if not found:
        return ""
    best = min(found)
    ids = {i for c in found if c[:3] == best[:3] for i in c[3:]}
    return min(ids) if best[0] < 2 or len(ids) == 1 else ""


#: The list a worker built last, so that its next tasks need not build it again.
_BUILT: dict[str, CanonicalList] = {}


def _built(mark: str, *parts) -> CanonicalList:
    if mark not in _BUILT:
        _BUILT.clear()
        _BUILT[mark] = CanonicalList(*parts)
    return _BUILT[mark]


def learn_fillers(values: DataFrame, shards: list, terms: list[str], variants: dict[int, str], partners: int = 20, most: int = 100_000) -> frozenset[str]:
    """Latin words that only embellish names: no word of the list or the dictionary, yet beside many of the list's words.

    A misspelled word stands beside the few words of one name, an embellishing
    one beside ``partners`` or more.  The list is checked to be no longer than
    ``most`` before it is collected.
    """
    counted = None
    for shard in shards:
        shared = values.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, shard, terms, variants))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tool = None
            for batch in batches:
                tool = tool or _built(*shared.value)
                pairs = {p for v in set(batch.column(0).to_pylist()) for p in tool.strangers(v)}
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], names=["word", "own"])

        rows = values.select("value").mapInArrow(run, "word string, own string").distinct()
        counted = rows if counted is None else counted.unionByName(rows)
    if counted is None:
        return frozenset()
    words = counted.distinct().groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= partners).limit(most + 1).collect()
    if len(words) > most:
        raise ValueError(f"more than {most} embellishing words can't be shipped to every task")
    own = {w for shard in shards for _, name, aliases in shard for v in (name, *aliases) for w in words_of(v or "", variants)}
    return frozenset(r.word for r in words) - own


def link_mentions(mentions: DataFrame, key: str, value: str, catalog: DataFrame, dictionary: DataFrame | None = None, shard_entries: int = 100_000, most_terms: int = 1_000_000) -> DataFrame:
    """(key, catalog_id) of every mention whose value is neither null nor blank.

    ``catalog`` has id, name and aliases, ``dictionary`` a column ``term``.
    Up to ``shard_entries`` entries are shipped to every task at a time; a
    longer list is searched shard by shard, each shard names its best
    candidates and the best of all wins, which gives what one search of the
    whole list gives.  A dictionary of more than ``most_terms`` raises an
    error.  Unmatched values give the empty string.  Each value is looked up
    where its row lies, repeated ones once a worker, so a value that a third
    of all rows share is no hot spot.  Rows repeated with one key count once;
    an empty catalog leaves all unmatched.
    """
    spark = mentions.sparkSession
    if dictionary is not None and dictionary.limit(most_terms + 1).count() > most_terms:
        raise ValueError(f"more than {most_terms} terms can't be shipped to every task")
    rows = catalog.where("id IS NOT NULL").select("id", "name", "aliases")
    n = rows.count()
    count = max(1, -(-n // shard_entries))
    shard = F.pmod(F.xxhash64("id"), F.lit(count))
    read = lambda k: sorted((r.id, r.name, list(r.aliases or [])) for r in rows.where(shard == k).collect())
    shards = [read(k) for k in range(count)] if n else []
    terms = sorted({r.term for r in dictionary.where("term IS NOT NULL").select("term").collect()}) if dictionary is not None else []
    variants = simplified_forms(spark)
    source = mentions.select(F.col(key).alias("key"), F.col(value).cast("string").alias("value"))
    source = source.where(F.length(F.regexp_replace("value", r"(?U)[\s　]+", "")) > 0)
    fillers = learn_fillers(source, shards, terms, variants)
    kind = source.schema["key"].dataType.simpleString()
    candidate = pa.struct([("way", pa.int32()), ("score", pa.int32()), ("place", pa.int32()), ("low", pa.string()), ("high", pa.string())])
    found = None
    for entries in shards or [[]]:
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, entries, terms, variants, fillers))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tool = None
            for batch in batches:
                tool = tool or _built(*shared.value)
                answers = [tool.remembered(v) for v in batch.column(1).to_pylist()]
                if count == 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([decided([a]) for a in answers], pa.string())], names=["key", "catalog_id"])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a and dict(zip(("way", "score", "place", "low", "high"), a)) for a in answers], candidate)], names=["key", "found"])

        if count == 1:
            found = source.mapInArrow(run, f"key {kind}, catalog_id string").groupBy("key").agg(F.max("catalog_id").alias("catalog_id"))
        else:
            part = source.mapInArrow(run, f"key {kind}, found struct<way:int,score:int,place:int,low:string,high:string>").groupBy("key").agg(F.max("found").alias("found"))
            found = part if found is None else found.unionByName(part)
    if count > 1:
        # Every shard gives one row for a key, so a key gathers as many as there are shards.
        best = found.groupBy("key").agg(F.array_sort(F.collect_list("found")).alias("all"))
        first = F.col("all")[0]
        same = F.filter("all", lambda c: (c["way"] == first["way"]) & (c["score"] == first["score"]) & (c["place"] == first["place"]))
        low, high = F.array_min(F.transform(same, lambda c: c["low"])), F.array_max(F.transform(same, lambda c: c["high"]))
        found = best.select("key", F.when(F.size("all") == 0, "").when((first["way"] < 2) | (low == high), low).otherwise("").alias("catalog_id"))
    return found.withColumnRenamed("key", key)
