"""Benchmark decontamination by template windows and slot consistency.

Words lose their outer punctuation and their case; words that are punctuation only are skipped. In a
template, numbers, units after numbers and names (capitalised words inside a sentence) become typed
slots. There are two template forms. In the first, each such word is a slot, and a capitalised word that
begins a sentence or line is a word like others. In the second, it may be a name too, and words of one kind
in a row, without a mark between them, are one slot ("New York", "1 200"), so values may be of other lengths;
it knows number words and units of four languages. Windows of ``WINDOW`` words (slots of the second form) of the benchmark's items, as templates and as plain words, are
hash-joined to the windows of all documents. The matches of a document and an item that lie on diagonals
(distances of their places) of at most ``GAP`` words' difference belong to one copy, which may have words put in
or left out. Its slots are consistent if each value of the item stands for one value of the document everywhere
in the copy, and different values for different ones; a question with other numbers or names passes, a text that
merely has the same frame with values mixed up does not.

A document is contaminated by an item if consistent matches cover half of the item's windows or
``RUN`` windows in a row's worth of them. Over all copies each window of the item counts once, and each
of the document, so a phrase that either repeats is not counted for each repetition. Items of fewer words (slots)
than a window are matched as one window of their own length: as plain words from one word on, as templates from
``LEAST``. Template windows need ``LITERAL`` words besides slots (half of a shorter item).

A Bloom filter of the benchmark's window hashes goes to the tasks that read the documents, so that windows of
no item stay there; the join decides. It has 16 bits for each hash, ``FILTER_BITS`` (32 MB) at most.

Defined results: null and empty texts match nothing; a null id keeps its row,
which is searched like others; repeated rows give equal
rows; rows of one id with different texts are judged each by its own text, and so are several texts of one item; no
rows, no result; an empty benchmark leaves everything clean. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm.lean import lean
from orderlake.llm.storage import cut
from orderlake.llm.words import mix, multipliers, sequence_hash, slices, words

WINDOW = 8
LITERAL = 4
LEAST = 5
#: Windows on one diagonal that are enough whatever the item's length: 13 words in a row.
RUN = 6
#: Difference of the diagonals of one copy.
GAP = 8
#: Largest Bloom filter, a power of two.
FILTER_BITS = 1 << 28

PLAIN, NUMBER, UNIT, NAME = range(4)
#: Plain words, template of single words, template of folded slots.
FORMS = (0, 1, 2)

NUMBERS = regex.compile(r"[\p{Sc}#+-]?\d[\d.,:/]*(?:%|st|nd|rd|th)?$")
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
#: Outer punctuation: all but letters and digits, a currency sign in front and a percent sign at the end.
OUTER = regex.compile(r"^[^\p{L}\p{N}\p{Sc}]+|[^\p{L}\p{N}%]+$")
MARKS = ".,;:!?\"'()[]{}<>*#&|/\\-_=+~^@`"
UNITS = frozenset(
    """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons
    ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
    cent cents dollar dollars euro euros usd eur gbp percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kph""".split()
)
#: A word that ends so is followed by the start of a sentence.
STOPS = (".", "!", "?", ":", ".\"", ".'", ".)", "!\"", "?\"", "…")

#: Number words and units of the second form: English, German, French and Spanish. Articles are none ("un", "ein").
ONES = "zwei zwo drei vier fünf sechs sieben acht neun".split()
TENS = "zwanzig dreißig dreissig vierzig fünfzig sechzig siebzig achtzig neunzig".split()
MORE_NUMBERS = NUMBER_WORDS | frozenset(
    """thirteen fourteen fifteen sixteen seventeen eighteen nineteen sixty seventy eighty ninety billion dozen
    null eins zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn hundert tausend million millionen milliarde milliarden dutzend
    zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt vingts trente quarante cinquante soixante septante
    huitante octante nonante cent cents mille millions milliard milliards douzaine
    cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte
    veintiuno veintiún veintiuna veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete veintiocho veintinueve treinta cuarenta cincuenta
    sesenta setenta ochenta noventa cien ciento doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos
    doscientas trescientas cuatrocientas quinientas seiscientas setecientas ochocientas novecientas mil millón millones docena""".split()
) | frozenset(ONES) | frozenset(TENS) | frozenset(f"{one}und{ten}" for one in ["ein", *ONES] for ten in TENS) | frozenset(f"{one}{much}" for one in ["ein", *ONES] for much in ("hundert", "tausend"))
MORE_UNITS = UNITS | frozenset(
    """millimeter zentimeter zoll fuß meile meilen gramm kilo kilos pfund unze unzen tonne tonnen milliliter gallonen sekunde sekunden minuten stunde stunden
    tag tage tagen woche wochen monat monate monaten jahr jahre jahren grad prozent
    millimètre millimètres centimètre centimètres mètre mètres kilomètre kilomètres pouce pouces pied pieds mille milles gramme grammes kilogramme kilogrammes
    livre livres once onces tonnes seconde secondes heure heures jour jours semaine semaines mois an ans année années degré degrés centime centimes
    milímetro milímetros centímetro centímetros metro metros kilómetro kilómetros pulgada pulgadas pie pies milla millas gramo gramos kilogramo kilogramos
    libra libras onza onzas tonelada toneladas litro litros segundo segundos minuto minutos hora horas día días semana semanas mes meses año años grado grados céntimo céntimos dólar dólares""".split()
)

U = np.uint64
HITS = "doc long, th long, rid long, place int, hash long, form int, slots array<struct<kind:int,value:string>>"


def _core(t: str) -> str:
    """A word without its outer punctuation; letters between common marks need no pattern."""
    if t.isalpha():
        return t
    s = t.strip(MARKS)
    return s if s.isalpha() or not s else OUTER.sub("", t)


def _kind(c: str) -> int:
    if c.isalpha():
        return NUMBER if c in NUMBER_WORDS else UNIT if c in UNITS else PLAIN
    return NUMBER if NUMBERS.match(c) else PLAIN


def _more(c: str, kind: int) -> int:
    """The kind in the second form."""
    if kind != PLAIN:
        return kind
    if c.isalpha():
        return NUMBER if c in MORE_NUMBERS else UNIT if c in MORE_UNITS else PLAIN
    parts = c.split("-")
    return NUMBER if len(parts) > 1 and parts[0] in MORE_NUMBERS and all(p in MORE_NUMBERS or p in ("one", "un", "une", "et") for p in parts) else PLAIN


def _kinds(own: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Core, kind in the first and second form, capital, end of sentence and mark at the end of each distinct word."""
    cores = [_core(t) for t in own]
    lowered = [c.lower() for c in cores]
    kind = np.array([_kind(c) for c in lowered], np.int8)
    capital = np.array([c[:1].isupper() for c in cores], bool)
    stop = np.array([t.endswith(STOPS) for t in own], bool)
    more = np.array([_more(c, k) for c, k in zip(lowered, kind.tolist(), strict=True)], np.int8)
    marked = np.array([not t[-1:].isalnum() for t in own], bool)
    return lowered, kind, more, capital, stop, marked


class Tokens:
    """Comparable words of a batch of texts: plain hashes, template hashes, kinds and the words.

    Forms are 0 (plain words), 1 and 2 (templates); ``first[form]`` has the places where texts begin.
    """

    def __init__(self, column: pa.Array):
        w = words(column)
        codes, distinct = pd.factorize(w.hashes())
        sample = np.zeros(len(distinct), np.int64)
        sample[codes[::-1]] = np.arange(len(codes))[::-1]
        text = w.data.tobytes()
        own = [text[a:b].decode() for a, b in zip(w.starts[sample].tolist(), w.ends[sample].tolist(), strict=True)]
        lowered, kind, more, capital, stop, marked = _kinds(own)
        raw = [t.encode() for t in lowered]
        size = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        plain = sequence_hash(flat, np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size, size, 43)
        full = (size > 0)[codes] if len(codes) else np.zeros(0, bool)
        begins = np.ones(len(codes), bool)
        if len(codes):
            line = np.zeros(len(w.data) + 1, np.int64)
            line[1:] = np.cumsum(w.data == 10)
            begins[1:] = (w.row[1:] != w.row[:-1]) | (line[w.starts[1:]] != line[w.ends[:-1]]) | stop[codes][:-1]
        self.code = codes[full]
        self.row = w.row[full]
        self.words = lowered
        begins, at = begins[full], np.flatnonzero(full)
        first_kind, second_kind = (self._placed(k[self.code] if len(self.code) else np.zeros(0, np.int8)) for k in (kind, more))
        capital = capital[self.code] if len(self.code) else np.zeros(0, bool)
        first_kind[capital & ~begins & (first_kind == PLAIN) & (kind[self.code] != UNIT if len(self.code) else True)] = NAME
        second_kind[capital & (second_kind == PLAIN)] = NAME
        plain = plain[self.code] if len(self.code) else np.zeros(0, U)
        # the second form's slots: words of one kind in a row, with no mark, line or text between them
        alone = np.ones(len(plain), bool)
        if len(plain):
            alone[1:] = (second_kind[1:] == PLAIN) | (second_kind[1:] != second_kind[:-1]) | (self.row[1:] != self.row[:-1]) | marked[self.code[:-1]] | begins[1:] | (np.diff(at) > 1)
        self.unit = np.flatnonzero(alone)
        self.end = np.append(self.unit[1:], len(plain))
        units = [np.arange(len(plain)), np.arange(len(plain)), self.unit]
        self.rows = [self.row[u] for u in units]
        self.kinds = [np.zeros(len(plain), np.int8), first_kind, second_kind[self.unit]]
        slot = multipliers(4, 47)
        self.hashes = [plain, np.where(first_kind == PLAIN, plain, slot[first_kind]), np.where(self.kinds[2] == PLAIN, plain[self.unit], slot[self.kinds[2]])]
        self.first = [np.searchsorted(r, np.arange(len(column) + 1), side="left") for r in self.rows]

    def _placed(self, kind: np.ndarray) -> np.ndarray:
        """Units that follow no number are plain."""
        after = np.zeros(len(kind), bool)
        after[1:] = (kind[:-1] == NUMBER) & (self.row[1:] == self.row[:-1])
        return np.where((kind == UNIT) & ~after, PLAIN, kind).astype(np.int8)

    def windows(self, form: int, size: int, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts of a form's windows of this size, and their hashes (0: too few words)."""
        row, kind, values = self.rows[form], self.kinds[form], self.hashes[form]
        n = len(row) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        start = np.flatnonzero(row[:n] == row[size - 1 :])
        if rows is not None:
            start = start[np.isin(row[start], rows)]
        m = multipliers(size, 53)
        h = np.zeros(len(start), U)
        for j in range(size):
            h += values[start + j] * m[j]
        h = h ^ h >> U(29) ^ U(size)
        if form:
            literal = np.concatenate(([0], np.cumsum(kind == PLAIN)))
            h[literal[start + size] - literal[start] < min(LITERAL, (size + 1) // 2)] = U(0)
        return start, h

    def slots(self, form: int, start: int, size: int) -> list[dict]:
        if not form:
            return []
        if form == 1:
            return [{"kind": int(self.kinds[1][j]), "value": self.words[self.code[j]]} for j in range(start, start + size) if self.kinds[1][j] != PLAIN]
        return [{"kind": int(self.kinds[2][j]), "value": " ".join(self.words[c] for c in self.code[self.unit[j] : self.end[j]])} for j in range(start, start + size) if self.kinds[2][j] != PLAIN]


def _item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All windows of all items, with the item's number of windows and the window's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                tokens = Tokens(part.column("body"))
                out = []
                for form in FORMS:
                    first = tokens.first[form]
                    count = np.diff(first)
                    for size in [WINDOW, *range(LEAST if form else 1, WINDOW)]:
                        start, hashes = tokens.windows(form, size, np.flatnonzero(count >= WINDOW) if size == WINDOW else np.flatnonzero(count == size))
                        for s, h in zip(start.tolist(), hashes.tolist(), strict=True):
                            r = int(tokens.rows[form][s])
                            if h:
                                out.append((part.column("item")[r].as_py(), part.column("item_th")[r].as_py(), int(count[r]) - size + 1, s - int(first[r]), size, int(np.uint64(h).astype(np.int64)), form, tokens.slots(form, s, size)))
                names = ["item", "item_th", "total", "item_place", "size", "hash", "form", "item_slots"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kinds[k]) for k in range(8)], names=names)

    schema = "item long, item_th long, total int, item_place int, size int, hash long, form int, item_slots array<struct<kind:int,value:string>>"
    return items.select(F.col(id_col).cast("long").alias("item"), F.xxhash64(text_col).alias("item_th"), F.col(text_col).alias("body")).filter("item is not null").mapInArrow(run, schema)


def _bits(hashes: np.ndarray, size: int, k: int) -> np.ndarray:
    """The k-th (of three) place of each hash in a filter of ``size`` bits (a power of two): its upper bits, mixed by a multiplication."""
    return hashes * (U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03), U(0xA0761D6478BD642F))[k] >> U(65 - size.bit_length())


def bloom_filter(hashes: DataFrame) -> np.ndarray:
    """Bytes of a Bloom filter of the column ``hash``: places in tasks, words put together in Spark."""
    count = hashes.count()
    size = min(FILTER_BITS, 1 << max(10, math.ceil(math.log2(16 * max(1, count)))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("hash").to_numpy().view(U)
            at = np.concatenate([_bits(own, size, k) for k in range(3)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], names=["word", "bits"])

    words_ = hashes.mapInArrow(place, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()  # at most size / 32
    out = np.zeros(size >> 5, np.uint32)
    out[np.array([r["word"] for r in words_], np.int64)] = np.array([r["bits"] for r in words_], np.uint32)
    return out


def _in_filter(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter may hold; few get beyond the first look."""
    left = np.arange(len(hashes))
    for k in range(3):
        at = _bits(hashes[left], len(filter_) << 5, k)
        left = left[(filter_[at >> U(5)] >> (at & U(31)).astype(np.uint32) & np.uint32(1)).astype(bool)]
    return left


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Matches: ``doc``, ``th`` (id and hash of the text), ``item``, number of consistent windows and of the item's windows."""
    known = cut(_item_windows(items, item_id, item_text).dropDuplicates(["item", "item_th", "item_place", "hash", "form"]))
    sizes = sorted((r["size"], r["form"]) for r in known.select("size", "form").distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(known.select("hash").distinct()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for part in slices(batch, "body"):
                tokens = Tokens(part.column("body"))
                places, hashes, forms, slots, rows = [], [], [], [], []
                for size, form in sizes:
                    start, h = tokens.windows(form, size)
                    hit = np.flatnonzero(h)
                    hit = hit[_in_filter(wanted, h[hit])]
                    for s, x in zip(start[hit].tolist(), h[hit].view(np.int64).tolist(), strict=True):
                        r = int(tokens.rows[form][s])
                        rows.append(r)
                        places.append(s - int(tokens.first[form][r]))
                        hashes.append(x)
                        forms.append(form)
                        slots.append(tokens.slots(form, s, size))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(rows, pa.int64())), part.column("th").take(pa.array(rows, pa.int64())),
                        pa.array(places, pa.int32()), pa.array(hashes, pa.int64()), pa.array(forms, pa.int32()),
                        pa.array(slots, pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))),
                    ],
                    names=["doc", "th", "place", "hash", "form", "slots"],
                )

    body = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("body")).filter("body is not null")
    if not sizes:
        body = body.limit(0)
    hits = body.mapInArrow(lean(run), HITS.replace("rid long, ", ""))
    pairs = hits.join(known, ["hash", "form"]).withColumn("diagonal", F.col("place") - F.col("item_place"))
    # slot by slot: (kind, the item's value, the document's value)
    met = F.expr("transform(arrays_zip(item_slots, slots), x -> struct(x.item_slots.kind as kind, x.item_slots.value as own, x.slots.value as other))")
    key = ["doc", "th", "item", "item_th", "form"]
    lines = pairs.groupBy(*key, "diagonal").agg(F.collect_set("item_place").alias("places"), F.max("total").alias("total"), F.array_distinct(F.flatten(F.collect_set(met))).alias("met"))
    # diagonals near each other are one copy
    along = Window.partitionBy(*key).orderBy("diagonal")
    parted = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(False)).cast("int")
    copies = lines.withColumn("apart", parted).withColumn("copy", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    told = F.array_distinct(F.flatten(F.collect_list("met").over(Window.partitionBy(*key, "copy"))))  # at most the copy's slots
    one_way = "size(array_distinct(transform(met, x -> struct(x.kind, x.{})))) = size(met)"
    lines = copies.withColumn("met", told).filter(f"{one_way.format('own')} and {one_way.format('other')}")
    lines = lines.select(*key, "diagonal", "total", F.size("places").alias("line"), F.explode("places").alias("own"))
    # a place counts once, the item's as well as the document's, in however many copies it lies
    lines = lines.withColumn("other", F.col("own") + F.col("diagonal")).groupBy(*key)
    lines = lines.agg(F.least(F.countDistinct("own"), F.countDistinct("other")).alias("windows"), F.max("line").alias("line"), F.max("total").alias("total"))
    enough = (2 * F.col("windows") >= F.col("total")) | (F.col("line") >= RUN)
    return lines.filter(enough).groupBy("doc", "th", "item").agg(F.max(F.struct("windows", "total")).alias("most")).select("doc", "th", "item", "most.*")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Id, whether the document is ``contaminated``, and the ``items`` it holds."""
    found = contamination(docs, items, id_col, text_col, item_id, item_text)
    found = found.groupBy("doc", "th").agg(F.array_sort(F.collect_set("item")).alias("items"))  # as many as the benchmark has
    found = found.withColumnsRenamed({"doc": "own_doc", "th": "own_th"})
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"))
    return rows.join(found, F.col("doc").eqNullSafe(F.col("own_doc")) & (F.col("th") == F.col("own_th")), "left").select(F.col("doc").alias(id_col), F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<long>")).alias("items"))


def op10_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
