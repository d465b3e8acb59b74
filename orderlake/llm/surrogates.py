"""Personal data replaced by surrogates of the same type, format, script and gender.

Patterns find e-mail addresses, telephone numbers, IPv4 addresses, social security numbers, IBANs, card
and account numbers, secrets (access keys, hexadecimal tokens after a name) and persons' names after a
title. Each entity has a canonical form, so that mentions in other spellings stay one entity: letters
without case, numbers without separators and in ASCII digits; given and family names stand apart, so that "Mrs. Ann Lee" and
"Mrs. Lee" keep one family name. Every other capitalised mention of such a name in the same document is one
too, with or without a title. A given name without gender ("Dr. Ann Lee") takes that of its other mentions,
first of the same full name, then of the document, then of all documents, if they agree.

A surrogate is drawn with a keyed hash of type, canonical form and attempt: digits become digits, letters
become letters of their script (vowels vowels, consonants consonants in names), lengths stay; octets,
check digits of cards and IBANs, and ranges stay valid; given names end by the gender of their title. All
distinct entities are drawn together and checked by joins: an entity whose surrogate another one has
already, or that is itself an entity of the data, draws again, until all are distinct. So different
entities keep different surrogates and no surrogate is a real value. Names and addresses grow by a letter if
they draw often; a format of fixed length may have too few values (four octets of one digit are 10,000): if an
entity of it has drawn ``ROUNDS`` times, all entities of its format take the value of the next one in an
order by keyed hash. They stay distinct, but are real values then. Every mention is written in its own format:
case and separators stay.

Texts are scanned for patterns once, and only those with a digit of any script, ``@``, a title or the
beginning of a secret; what comes back are the mentions of each text, by its hash. They are joined to their
surrogates, put in format, and spliced by Spark into the texts that have such a sign; the others don't move.

Defined results: null and empty texts stay; a null id keeps its row, and its entities are replaced too;
repeated rows give equal rows; no rows, no result. Other columns stay as they are; where the input has a
column of a result's name, the result's has ``pii_`` in front.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm.lean import lean
from orderlake.llm.storage import cut

#: Default key; deployments pass their own.
KEY = "surrogates"
#: Attempts at one length; then names and addresses grow by a letter.
SAME_LENGTH = 8
#: Draws after which a format of fixed length counts as used up.
ROUNDS = 12
#: Kinds whose surrogates never grow.
FIXED = ("ip", "ssn", "card", "phone", "iban", "secret")

# Titles by gender (fixed lists in the languages of the data)
MALE = "Mr Herr Señor Sr Don Monsieur".split()
FEMALE = "Mrs Ms Miss Frau Señora Sra Doña Madame Mme Mlle".split()
NEUTRAL = "Dr Prof Professor Doctor".split()

_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
#: What a text must have to hold any entity: a digit of any script or ``@``, a title, or a secret that may be of letters only.
_SIGN = re.compile(r"[\d@]")
_WORDS = (*MALE, *FEMALE, *NEUTRAL, "AKIA", "ASIA")
_QUOTED = re.compile(r"""[=:][ ]?["'][0-9A-Za-z+/_-]{20}""")


def may_hold_entities(text: str) -> bool:
    return _SIGN.search(text) is not None or any(w in text for w in _WORDS) or (('"' in text or "'" in text) and _QUOTED.search(text) is not None)


_NAME = r"\p{Lu}[\p{Ll}\p{M}'’-]+"
PATTERN = regex.compile(
    rf"""
      (?P<email>[\p{{L}}\p{{N}}._%+-]+@(?:[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])?\.)+\p{{L}}{{2,}})
    | (?P<iban>\b[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
    | (?P<secret>\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b|(?<=[\p{{L}}_][ ]?[=:][ ]?["'])[0-9A-Za-z+/_-]{{20,}}(?=["'])|\b(?=[0-9a-f]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{{32,64}}\b)
    | (?P<ip>(?<![\d.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){{3}}(?!\.?\d))
    | (?P<ssn>(?<![\d-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))
    | (?P<card>(?<![\d-])\d{{4}}(?:[ -]\d{{4}}){{2}}[ -]\d{{1,7}}(?![\d-])|(?<!\d)\d{{13,19}}(?!\d))
    | (?P<phone>(?<![\w.])(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{3,4}}[ .-]?\d{{3,4}}(?!\w)|(?<![\w.])\+\d{{8,15}}(?!\w))
    | (?<![\p{{L}}])(?P<title>{_TITLES})\.?[ ]+(?:(?P<given>{_NAME})[ ]+)?(?P<family>{_NAME})
    """,
    regex.X,
)

#: A capitalised word, whole, and its parts between apostrophes and hyphens.
WORD = regex.compile(r"(?<![\p{L}\p{M}\p{N}_])\p{Lu}[\p{L}\p{M}]*(?:['’-][\p{L}\p{M}]+)*(?![\p{L}\p{M}\p{N}_])")
PART = regex.compile(r"[\p{L}\p{M}]+")
#: What follows a name and is not part of it.
ENDING = regex.compile(r"(?:['’][sS]|['’-])$")

_VOWELS = "aeiouy"
_CONSONANTS = "bcdfghjklmnpqrstvwxz"
_CYRILLIC = ("аеиоуыэюя", "бвгджзклмнпрстфхцчшщ")
_GREEK = ("αεηιουω", "βγδζθκλμνξπρστφχψ")


class _Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: str, *parts: str):
        self.key, self.parts, self.n, self.pool = key.encode(), "\x1f".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.parts + b"\x1f" + str(self.n).encode(), hashlib.sha256).digest()
            self.n += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


def _letter(draw: _Draw, c: str, name: bool) -> str:
    """A lower-case letter of the same script; in names a vowel for a vowel."""
    base = unicodedata.normalize("NFD", c)[0]
    for vowels, consonants in (_CYRILLIC, _GREEK):
        if base in vowels + consonants or c in vowels + consonants:
            return draw.of((vowels if base in vowels else consonants) if name else vowels + consonants)
    if "LATIN" in unicodedata.name(c, ""):
        return draw.of((_VOWELS if base in _VOWELS else _CONSONANTS) if name else _VOWELS + _CONSONANTS)
    code = ord(c)  # other scripts: a letter near it that has the same class
    near = [chr(x) for x in range(code - code % 32, code - code % 32 + 32) if unicodedata.category(chr(x)) == unicodedata.category(c)]
    return draw.of("".join(near) or c)


def _luhn(digits: str) -> int:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def surrogate(kind: str, canon: str, attempt: int, key: str = KEY) -> str:
    """Canonical surrogate of a canonical entity."""
    draw = _Draw(key, kind, canon, str(attempt))
    longer = attempt // SAME_LENGTH
    if kind == "ip":
        ranges = {1: (0, 9), 2: (10, 99), 3: (100, 255)}
        return ".".join(str(lo + draw.below(hi - lo + 1)) for lo, hi in (ranges[len(o)] for o in canon.split(".")))
    if kind == "ssn":
        area = 1 + draw.below(898)
        return f"{area + (area >= 666):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "card":
        body = str(1 + draw.below(9)) + "".join(str(draw.below(10)) for _ in canon[2:])
        check = _luhn(body)
        return body + str(check if _luhn(canon[:-1]) == int(canon[-1]) else (check + 1 + draw.below(9)) % 10)
    if kind == "phone":
        plus, number = canon.split("|")
        return plus + "|" + "".join(str(draw.below(10)) for _ in number)
    if kind == "iban":
        body = "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in canon[4:])
        number = int("".join(str(int(c, 36)) for c in body + canon[:2] + "00"))
        return f"{canon[:2]}{98 - number % 97:02d}{body}"
    if kind == "secret":
        hexadecimal = re.fullmatch(r"[0-9a-f]+", canon) is not None
        head = canon[:4] if canon[:4] in ("AKIA", "ASIA") else ""
        out = [draw.of("0123456789") if c.isdigit() else draw.of("abcdef") if hexadecimal else chr((97 if c.islower() else 65) + draw.below(26)) if c.isalpha() and c.isascii() else c for c in canon[len(head) :]]
        return head + "".join(out)
    if kind == "email":
        local, domain = canon.rsplit("@", 1)
        labels = domain.split(".")
        change = lambda t: "".join(str(draw.below(10)) if c.isdigit() else _letter(draw, c, False) if c.isalpha() else c for c in t)
        return change(local) + "".join(draw.of(_CONSONANTS) for _ in range(longer)) + "@" + ".".join([*map(change, labels[:-1]), labels[-1]])
    # names: kind is "family", or "given" with the gender in front of the canonical form
    gender, _, own = canon.rpartition("|")
    out = "".join(_letter(draw, c, True) if c.isalpha() else c for c in own) + "".join(draw.of(_VOWELS if k % 2 else _CONSONANTS) for k in range(longer * 2))
    if own[:1].isascii() and gender in ("f", "m"):
        out = out[:-1] + (draw.of("a") if gender == "f" else draw.of("nosr"))
    return f"{gender}|{out}" if gender else out


def _ascii(value: str) -> str:
    """Digits of all scripts as 0-9."""
    return value if value.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in value)


def _name(m: regex.Match, group: str, text: str) -> tuple[int, int, str]:
    """Begin, end and lower-case form of a name, without the ending of a genitive."""
    a, b = m.span(group)
    end = ENDING.search(text, a, b)
    if end and end.start() > a + 1 and not text[b : b + 1].isalpha():
        b = end.start()
    return a, b, text[a:b].lower()


class _Persons:
    """Names after titles in one document."""

    def __init__(self):
        self.given: dict[str, set[str]] = {}
        self.full: dict[tuple[str, str], set[str]] = {}
        self.family: set[str] = set()

    def add(self, gender: str, given: str | None, family: str) -> None:
        self.family.add(family)
        if given:
            for known, name in ((self.given, given), (self.full, (given, family))):
                known.setdefault(name, set()).update({gender} - {"n"})

    def canon(self, given: str, family: str | None) -> str:
        for known in (self.full.get((given, family), set()), self.given[given]):
            if len(known) == 1:
                return f"{min(known)}|{given}"
        return f"n|{given}"


def _untitled(text: str, found: list[tuple[int, int, str, str]], persons: _Persons) -> list[tuple[int, int, str, str]]:
    """All mentions: those found, and the words between them that are names of the document's persons."""
    out, at = [], 0
    for mention in [*found, (len(text), len(text), "", "")]:
        words = []
        for m in WORD.finditer(text, at, mention[0]):
            whole = m.group().lower()
            if whole in persons.given or whole in persons.family:
                words.append((*m.span(), whole))
            else:
                words += [(*p.span(), p.group().lower()) for p in PART.finditer(text, *m.span()) if p.group()[0].isupper() and (p.group().lower() in persons.given or p.group().lower() in persons.family)]
        for k, (a, b, name) in enumerate(words):
            after = words[k + 1] if k + 1 < len(words) and words[k + 1][2] in persons.family and text[b : words[k + 1][0]].isspace() else None
            if name in persons.given and (after or name not in persons.family):
                out.append((a, b, "given", persons.canon(name, after[2] if after else None)))
            else:
                out.append((a, b, "family", name))
        out.append(mention)
        at = mention[1]
    return out[:-1]


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """Begin, end, kind and canonical form of every mention, in order."""
    found, persons, titled = [], _Persons(), []
    for m in PATTERN.finditer(text):
        kind = m.lastgroup
        if m["title"]:
            gender = "f" if m["title"] in FEMALE else "m" if m["title"] in MALE else "n"
            family = _name(m, "family", text)
            given = _name(m, "given", text) if m["given"] else None
            if given and text[given[1] : m.end("given")].lower().endswith("s"):  # "Mr. Lee's Garden": a genitive ends the name
                given, family = None, given
            persons.add(gender, given and given[2], family[2])
            if given:
                titled.append((len(found), gender, given[2], family[2]))
                found.append((*given[:2], "given", f"{gender}|{given[2]}"))
            found.append((*family[:2], "family", family[2]))
            continue
        value = m[kind] if kind in ("email", "secret", "iban") else _ascii(m[kind])
        if kind == "phone":
            plus = re.match(r"\+\d{1,3}(?=[ .(-])", value)
            head = plus.group() if plus else ""
            canon = head + "|" + re.sub(r"\D", "", value[len(head) :])
        elif kind in ("card", "ssn"):
            canon = re.sub(r"\D", "", value)
        elif kind == "iban":
            canon = value.replace(" ", "")
        else:
            canon = value if kind in ("secret", "ip") else value.lower()
        found.append((m.start(), m.end(), kind, canon))
    for place, gender, given, family in titled:
        if gender == "n":
            found[place] = (*found[place][:3], persons.canon(given, family))
    return _untitled(text, found, persons) if persons.family else found


def written(value: str, kind: str, new: str) -> str:
    """A canonical surrogate in the format of a mention."""
    if kind in ("card", "ssn", "phone", "ip") and not value.isascii():  # each digit in the script of its place
        plain = written(_ascii(value), kind, new)
        return "".join(chr(ord(c) - unicodedata.decimal(c) + int(n)) if c.isdecimal() and n.isdecimal() else n for c, n in zip(value, plain, strict=True))
    if kind in ("ip", "secret"):
        return new
    if kind in ("card", "ssn", "phone", "iban"):
        head, _, body = new.rpartition("|")
        chars = iter(body)
        return head + "".join(next(chars, "") if c.isalnum() else c for c in value[len(head) :])
    new = new.rpartition("|")[2]
    if value.isupper():
        return new.upper()
    cased = [n.upper() if k < len(value) and value[k].isupper() else n for k, n in enumerate(new)]
    return "".join(cased)


def shape(kind: str, canon: str) -> str:
    """The format of a canonical entity: entities of other formats never share a surrogate."""
    if kind == "card":
        return f"{len(canon)}{'v' if _luhn(canon[:-1]) == int(canon[-1]) else 'n'}"
    if kind == "phone":
        plus, number = canon.split("|")
        return f"{plus}|{len(number)}"
    head = canon[:4] if kind == "iban" or canon[:4] in ("AKIA", "ASIA") else ""
    return head[:2] + "".join("0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in canon)


def draw_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind``, ``canon`` and a ``surrogate`` for each: distinct, and no entity of the input where the format has room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [surrogate(k, c, a, key) for k, c, a in zip(*(batch.column(n).to_pylist() for n in ("kind", "canon", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("kind", "canon", "attempt")), pa.array(drawn, pa.string())], names=["kind", "canon", "attempt", "surrogate"])

    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, canons = batch.column("kind").to_pylist(), batch.column("canon").to_pylist()
            order = [hmac.new(key.encode(), f"{k}\x1f{c}".encode(), hashlib.sha256).hexdigest() for k, c in zip(kinds, canons, strict=True)]
            shapes = [shape(k, c) for k, c in zip(kinds, canons, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("canon"), pa.array(shapes, pa.string()), pa.array(order, pa.string())], names=["kind", "canon", "shape", "place"])

    schema = "kind string, canon string, attempt int, surrogate string"
    columns = ["kind", "canon", "attempt", "surrogate"]
    known = cut(entities.select("kind", "canon").distinct())
    now = cut(known.withColumn("attempt", F.lit(0)).mapInArrow(run, schema))
    real = known.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
    swapped = None
    while True:
        order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "canon")  # short: equal draws are chance
        checked = cut(now.withColumn("place", F.row_number().over(order)).join(real, ["kind", "surrogate"], "left").withColumn("again", F.col("real").isNotNull() | (F.col("place") > 1)))
        again = checked.filter("again")
        if again.isEmpty():
            done = checked.select("kind", "canon", "surrogate")
            return done if swapped is None else done.unionByName(swapped)
        stuck = again.filter((F.col("attempt") >= ROUNDS) & F.col("kind").isin(*FIXED))
        if not stuck.isEmpty():
            of_shape = "kind string, canon string, shape string, place string"
            full = stuck.select("kind", "canon").mapInArrow(formed, of_shape).select("kind", "shape").distinct()
            members = known.filter(F.col("kind").isin(*FIXED)).mapInArrow(formed, of_shape).join(full, ["kind", "shape"])
            ring = Window.partitionBy("kind", "shape").orderBy("place", "canon")  # at most the values of a small format
            first = F.first("canon").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            turned = cut(members.withColumn("surrogate", F.coalesce(F.lead("canon").over(ring), first)).select("kind", "canon", "surrogate"))
            swapped = turned if swapped is None else swapped.unionByName(turned)
            checked = checked.join(turned.select("kind", "canon"), ["kind", "canon"], "left_anti")
        redrawn = checked.filter("again").select("kind", "canon", (F.col("attempt") + 1).alias("attempt")).mapInArrow(run, schema)
        now = cut(checked.filter("not again").select(*columns).unionByName(redrawn))


def _of_one_gender(found: DataFrame, key: str) -> DataFrame:
    """``draw_surrogates``, but given names without gender share that of all others of the name, if those have one."""
    entities = cut(found.select("kind", "canon").distinct())
    gendered = entities.filter("kind = 'given' and canon not like 'n|%'")
    gendered = gendered.groupBy(F.concat(F.lit("n|"), F.substring_index("canon", "|", -1)).alias("canon")).agg(F.min("canon").alias("same"), F.count("*").alias("genders"))
    gendered = gendered.filter("genders = 1").select(F.lit("given").alias("kind"), "canon", "same")
    named = cut(entities.join(gendered, ["kind", "canon"], "left").select("kind", "canon", F.coalesce("same", "canon").alias("same")))
    table = draw_surrogates(named.select("kind", F.col("same").alias("canon")), key).withColumnRenamed("canon", "same")
    return named.join(table, ["kind", "same"]).select("kind", "canon", "surrogate")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mentions of the texts that have any, by the hash of the text."""
    names = ["hash", "a", "b", "kind", "canon", "value"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        rows = []
        for text in batch.column("text"):  # one at a time: most hold nothing
            text = text.as_py()
            if text and may_hold_entities(text) and (found := mentions(text)):
                own = hashlib.md5(text.encode()).hexdigest()
                rows += [(own, a, b, kind, canon, text[a:b]) for a, b, kind, canon in found]
            if len(rows) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        new = [written(v, k, s) for v, k, s in zip(*(batch.column(n).to_pylist() for n in ("value", "kind", "surrogate")), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("hash", "a", "b")), pa.array(new, pa.string())], names=["hash", "a", "b", "new"])


def replace_entities(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """All rows and columns with surrogates in the text, and ``pii_entities``, the number of mentions replaced."""
    taken = {c.lower() for c in docs.columns}
    count = "pii_entities"
    while count in taken:
        count = f"pii_{count}"
    found = cut(docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(lean(_found), "hash string, a int, b int, kind string, canon string, value string").distinct())
    table = _of_one_gender(found, key)
    new = found.join(table, ["kind", "canon"]).select("hash", "a", "b", "kind", "value", "surrogate").mapInArrow(lean(_formatted), "hash string, a int, b int, new string")
    known = new.groupBy("hash").agg(F.array_sort(F.collect_list(F.struct("a", "b", "new"))).alias("spans"))  # what one text holds

    @F.arrow_udf("boolean")
    def maybe(texts: pa.Array) -> pa.Array:
        return pa.array([t is not None and may_hold_entities(t) for t in (x.as_py() for x in texts)], pa.bool_())

    # the columns of the input under numbers, so that no name clashes
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    at = f"c{docs.columns.index(text_col)}"
    # only texts with a sign of entities move; always by a merge join, so that the plan is one at every size
    joined = rows.filter(maybe(at)).withColumn("own", F.md5(F.col(at).cast("binary"))).join(known.hint("merge"), F.col("own") == F.col("hash"), "left")
    spliced = F.expr(
        f"""concat(concat_ws('', transform(spans, (s, i) -> concat(
            substring({at}, if(i = 0, 0, spans[i - 1].b) + 1, s.a - if(i = 0, 0, spans[i - 1].b)), s.new))),
            substring({at}, element_at(spans, -1).b + 1))"""
    )
    changed = F.when(F.col("spans").isNotNull(), spliced).otherwise(F.col(at))

    def named(text: Column, number: Column) -> list[Column]:
        return [*[(text if f"c{k}" == at else F.col(f"c{k}")).alias(c) for k, c in enumerate(docs.columns)], number.cast("int").alias(count)]

    rest = rows.filter(~maybe(at)).select(*named(F.col(at), F.lit(0)))
    return joined.select(*named(changed, F.coalesce(F.size("spans"), F.lit(0)))).unionByName(rest)


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(docs)
