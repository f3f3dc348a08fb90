"""Private data: detection and replacement by keyed surrogates.

Entities (mail addresses, phone, social-security, card and bank account numbers, IP
addresses, titled names, given and family part apart, and their later untitled mentions in
the text) are found in every text; each distinct entity, in its plain form, gets one surrogate
of its own from a keyed hash, so a person mentioned twice stays one person (coreference) and
two stay two (distinctness).  A surrogate has its entity's type and shape: letters for
letters, digits for digits, a valid check digit if there was one, octets below 256, a name of
the same gender and script; how it was written (case, blanks, brackets) is kept.

Collision check: surrogates drawn twice, or equal to an entity that really occurs, are
drawn again (all but the first of equals) until none collides; after some draws they grow by
a character, so the search ends.  It runs on the distinct entities, as joins and grouped
minima, and a name or number that a third of all rows hold is one row there.

Cases: null and empty texts have no entities and stay; very long texts are scanned whole;
repeated rows are changed alike; overlapping finds go to the longer, then the earlier; an
empty table gives an empty result; further columns are returned as they are.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm import common as C

KINDS = ("email", "ssn", "phone", "ip", "card", "name", "ipv6", "iban")
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(
        r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)"
        r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,5}\)|[ .-]\d{1,5})(?:[ .-]?\d{2,8}){1,5}(?![\w-])"  # country code, groups of any size
        r"|(?<![\w+.-])(?:0\d|\(0\d\))(?:[ .-]\d{2}){4}(?![\w-])"  # groups of two
        r"|(?<![\w+.-])(?:[67]\d{2}(?:[ -]\d{2}){3}|[89]\d{2}(?:[ -]\d{2}){3}|9\d[ -]\d{3}(?:[ -]\d{2}){2})(?![\w-])"
        r"|(?<![\w+.-])(?:8[ -]?)?(?:\(\d{3,5}\)[ -]?\d{2,3}|\d{3,5}[ -]\d{3})[ -]\d{2}[ -]\d{2}(?![\w-])"  # 8 (495) 123-45-67
        r"|(?<![\w+.-])(?:\(0\d{1,5}\)|0\d{1,5})[ /-]\d{4,9}(?![\w-])|(?<![\w+.-])(?:2\d{2,3}|69\d)[ .-]\d{6,7}(?![\w-])"),  # two groups
    "ip": re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"),
    "card": re.compile(r"(?<![\w.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])"),
    "ipv6": re.compile(r"(?<![\w:.])[0-9A-Fa-f:]{3,39}(?![\w:]|\.\d)"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "name": re.compile(
        r"(?<!\w)(?P<title>Mr\.?|Mrs\.?|Ms\.?|Miss|Herr|Frau|Monsieur|Madame|Mme|Señora?|Sra?\.|господин|госпожа|г-н|г-жа|κύριος|κυρία|Κύριος|Κυρία|Господин|Госпожа)"
        r" (?P<name>[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][\w'’-]+(?: [A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][\w'’-]+)?)"),
}
# fixed values: titles of women (the others are men's) and given names by script and gender
WOMEN = {"mrs", "ms", "miss", "frau", "madame", "mme", "señora", "sra", "госпожа", "г-жа", "κυρία"}
GIVEN = {
    ("latin", "f"): "Ada Clara Edith Flora Greta Helen Irene Julia Marta Nora Paula Rosa Sonia Vera".split(),
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Henri Ivan Jonas Leon Martin Oscar Paul Victor".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Лев Павел Роман".split(),
    ("greek", "f"): "Άννα Δάφνη Ειρήνη Ελένη Ζωή Ιωάννα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Νίκος Πέτρος Σπύρος".split(),
}
SYLLABLES = {
    "latin": "bar ben cor dal den far gan hol kar lan mar mor nel pen ran ros sal ten val wil".split(),
    "cyrillic": "бар вол гор дан зор кар лен мир нов пет рос сал тар".split(),
    "greek": "βαρ γαλ δαν καρ λαμ μαν νικ παπ ρος σαρ ταλ".split(),
}
WORD = re.compile(r"(?<![\w@.-])\w[\w'’-]+(?!@)")
TITLES = tuple(t.encode() for t in "Mr Mrs Ms Miss Herr Frau Monsieur Madame Mme Se Sr господин госпожа г-н г-жа κύριος κυρία Κύριος Κυρία Господин Госпожа".split())
_NOT_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("shown", pa.string()), ("value", pa.string())])
SPANS = "array<struct<kind:string,start:int,end:int,shown:string,value:string>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def script(text: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", text) else "greek" if re.search("[Α-Ωα-ωά-ώ]", text) else "latin"


def check_digits(iban: str) -> str:
    """The two check digits that an account number of this country and rest has."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in iban[4:] + iban[:2] + '00')) % 97:02d}"


def name_parts(match: re.Match) -> list[tuple[int, int, str]]:
    """(start, end, plain value) of a titled name's given and family part; a value is the
    given name's gender or nothing, and the part."""
    g = "f" if match["title"].rstrip(".").lower() in WOMEN else "m"
    out, at = [], match.start("name")
    words = match["name"].split(" ")
    for k, w in enumerate(words):
        whole, w = w, re.sub(r"['’]s?$", "", w) or w
        out.append((at, at + len(w), f"{g if k < len(words) - 1 else ''}:{w.casefold()}"))
        at += len(whole) + 1
    return out


def plain(kind: str, match: re.Match) -> tuple[int, int, str] | None:
    """(start, end, plain value) of a match, or None if it is none."""
    text = match[0]
    if kind == "ipv6":
        try:
            value = str(ipaddress.IPv6Address(text))
        except ValueError:
            return None
        groups = [x for x in value.split(":") if x]
        return (*match.span(), value) if len(groups) > 1 and any(map(str.isdigit, value)) and "." not in value else None
    if kind == "iban":
        while len(text.replace(" ", "")) >= 15:  # words in capitals may follow it
            value = text.replace(" ", "")
            if len(value) <= 34 and check_digits(value) == value[2:4]:
                return match.start(), match.start() + len(text), value
            text = text.rpartition(" ")[0]
        return None
    if kind == "email":
        return *match.span(), text.lower()
    if kind == "ip":
        return (*match.span(), text) if all(int(x) < 256 for x in text.split(".")) else None
    digits = re.sub(r"\D", "", text)
    if kind == "phone" and not 8 <= len(digits) <= 15:
        return None
    return *match.span(), digits


def detect(raw: bytes) -> list[dict]:
    """Entities of a text, in code points, end exclusive; no two overlap."""
    kinds = []
    if b"@" in raw:
        kinds.append("email")
    if len(raw.translate(None, _NOT_DIGITS)) >= 4:
        kinds += ["ssn", "phone", "ip", "card", "iban"]
    if b"::" in raw or raw.count(b":") >= 7:
        kinds.append("ipv6")
    if any(t in raw for t in TITLES):
        kinds.append("name")
    if not kinds:
        return []
    text = raw.decode("utf-8", "replace")
    found = []
    for kind in kinds:
        for m in PATTERNS[kind].finditer(text):
            if kind == "name":
                found += [(s - e, s, KINDS.index(kind), e, value) for s, e, value in name_parts(m)]
                continue
            if (p := plain(kind, m)) is not None:
                found.append((p[0] - p[1], p[0], KINDS.index(kind), p[1], p[2]))
    names: dict = {}  # a part as written, and where it is named first
    for _, s, k, e, value in sorted((f for f in found if KINDS[f[2]] == "name"), key=lambda f: f[1]):
        for word in (text[s:e], text[s:e].upper()):
            names.setdefault(word, (e, k, value))
    if names:
        for m in WORD.finditer(text):
            w = re.sub(r"['’]s?$", "", m[0])
            if w in names and m.start() >= names[w][0]:
                found.append((-len(w), m.start(), *names[w][1:2], m.start() + len(w), names[w][2]))
    out, taken = [], []
    for _, s, k, e, value in sorted(set(found)):
        if all(e <= a or b <= s for a, b in taken):
            taken.append((s, e))
            out.append({"kind": KINDS[k], "start": s, "end": e, "shown": text[s:e], "value": value})
    return sorted(out, key=lambda x: x["start"])


class Draw:
    """A keyed stream of small numbers for one (entity, attempt)."""

    def __init__(self, key: bytes, *what: str):
        self.key, self.what, self.pool, self.n = key, "\0".join(what).encode(), b"", 0

    def below(self, m: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.what + self.n.to_bytes(4, "big"), sha256).digest()
            self.n += 1
        v, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return v % m


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The plain form of an entity's stand-in; from the ninth draw on it grows."""
    d = Draw(key, kind, value, str(attempt))
    more = max(0, attempt - 8)
    letter = lambda: chr(97 + d.below(26))
    shape = lambda s: "".join(str(d.below(10)) if c.isdigit() else letter() if c.isalpha() else c for c in s)
    if kind == "email":
        local, _, domain = value.partition("@")
        *labels, top = domain.split(".")
        return shape(local) + "".join(letter() for _ in range(more)) + "@" + ".".join([*map(shape, labels), top])
    if kind == "ip":
        return ".".join(str(1 + d.below(254)) for _ in range(4))
    if kind == "name":
        g, _, name = value.partition(":")
        s = script(name)
        syllables = lambda n: "".join(SYLLABLES[s][d.below(len(SYLLABLES[s]))] for _ in range(n))
        if not g:
            return ":" + syllables(2 + d.below(2) + more)
        # given names are few: drawn again, they grow at once
        return f"{g}:" + GIVEN[s, g][d.below(len(GIVEN[s, g]))].casefold() + syllables(attempt)
    if kind == "ipv6":
        hexes = lambda n: "123456789abcdef"[d.below(15)] + "".join("0123456789abcdef"[d.below(16)] for _ in range(n - 1))
        return ":".join(hexes(4) for _ in range(8)) if more else re.sub("[0-9a-f]+", lambda m: hexes(len(m[0])), value)
    if kind == "iban":
        rest = "".join(str(d.below(10)) if c.isdigit() else letter().upper() for c in value[4:])
        return value[:2] + check_digits(value[:4] + rest) + rest
    keep = len(value) - 10 if kind == "phone" and len(value) > 10 else 0  # the country code stays
    if kind == "phone" and not keep and value[0] == "0":
        keep = 1  # so does a leading zero
    digits = value[:keep] + str(6 + d.below(4) if kind == "phone" and not keep and value[0] in "6789" else 1 + d.below(9)) + "".join(str(d.below(10)) for _ in range(len(value) - keep - 1 + more))
    if kind == "card":
        valid = luhn(value)
        for last in map(str, range(10)):
            if luhn(digits[:-1] + last) == valid:
                return digits[:-1] + last
    return digits


def shown(kind: str, was: str, value: str) -> str:
    """A surrogate written as the entity was."""
    if kind == "name":
        word = value.partition(":")[2]
        return word.upper() if was.isupper() and len(was) > 1 else word[:1].upper() + word[1:]
    if kind == "email":
        return value.upper() if was.isupper() else "".join(v.upper() if o.isupper() else v for v, o in zip(value, was, strict=False)) + value[len(was):]
    if kind == "ip":
        return value
    if kind == "ipv6":
        return value.upper() if was.upper() == was != was.lower() else value
    if kind == "iban":
        chars = iter(value)
        return "".join(next(chars) if c != " " else c for c in was)
    digits = iter(value)
    return "".join(next(digits, c) if c.isdigit() else c for c in was) + "".join(digits)


def entities(docs: DataFrame, text_col: str) -> DataFrame:
    """(kind, value): every distinct entity of the texts."""

    def run(batches):
        for b in batches:
            seen = sorted({(e["kind"], e["value"]) for raw in b.column(0).to_pylist() for e in detect(raw)})
            yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in seen], pa.string()) for i in range(2)], ["kind", "value"])

    return C.map_batches(docs.select(C.text_bytes(text_col).alias("text")), run, "kind string, value string").distinct()


def assign(ents: DataFrame, key: bytes, scratch: C.Scratch, draw: Callable = surrogate) -> DataFrame:
    """(kind, value, surrogate), distinct surrogates, none of them an entity itself."""

    def drawn(rows: DataFrame, attempt: int) -> DataFrame:
        def run(batches):
            for b in batches:
                made = [draw(key, k, v, attempt) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], ["kind", "value", "surrogate"])

        return rows.mapInArrow(run, "kind string, value string, surrogate string")

    ents = scratch.table(ents, "entities")
    real = ents.select(F.col("kind").alias("rk"), F.col("value").alias("rv"))
    done, pending, attempt = None, ents, 0
    while True:
        now = scratch.table(drawn(pending, attempt), f"drawn-{attempt}")
        free = now.join(real, (F.col("kind") == F.col("rk")) & (F.col("surrogate") == F.col("rv")), "left_anti")
        if done is not None:
            used = done.select(F.col("kind").alias("uk"), F.col("surrogate").alias("us"))
            free = free.join(used, (F.col("kind") == F.col("uk")) & (F.col("surrogate") == F.col("us")), "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate")
        done = scratch.table(won if done is None else done.union(won), f"done-{attempt}")
        pending = scratch.table(pending.join(done.select(F.col("kind").alias("dk"), F.col("value").alias("dv")),
                                             (F.col("kind") == F.col("dk")) & (F.col("value") == F.col("dv")), "left_anti"), f"pending-{attempt}")
        if pending.isEmpty():
            return done
        attempt += 1
        if attempt > 200:
            raise RuntimeError("no free surrogates: a type's space is used up")


def replace(docs: DataFrame, key: bytes, text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """``docs`` with every entity replaced in ``text_col``; with ``with_spans`` also the
    column ``entities`` (its name free of clashes): (kind, start, end) in the original and
    the stand-in written there."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "private")
    table = assign(entities(docs, text_col), key, scratch)
    raw, spans, row, news_col, marks_col = C.fresh(docs, "raw_text", "spans", "row", "news", "entities")
    n = len(docs.columns)

    def pick(with_entities: bool):
        def run(batches):
            for b in batches:
                found = [detect(x) for x in b.column(n).to_pylist()]
                part = pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(found, pa.list_(SPAN))], [*b.schema.names[:n], spans])
                yield part.filter(pa.array([bool(f) == with_entities for f in found], pa.bool_()))

        kind = T.StructType([*docs.schema.fields, *spark.createDataFrame([], f"{spans} {SPANS}").schema.fields])
        return C.map_batches(docs.withColumn(raw, C.text_bytes(text_col)), run, kind)

    # few rows have entities: only they are written, joined and shuffled
    hit = scratch.table(pick(True).withColumn(row, F.monotonically_increasing_id()), "hit")
    each = hit.select(F.col(row).alias("r"), F.explode(spans).alias("e")).select("r", "e.*")
    t = table.select(F.col("kind").alias("k"), F.col("value").alias("v"), "surrogate")
    news = each.join(t, (F.col("kind") == F.col("k")) & (F.col("value") == F.col("v"))) \
        .groupBy(F.col("r").alias("news_row")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "shown", "surrogate"))).alias(news_col))
    hit_names, out_kind = docs.columns, T.StructType([*docs.schema.fields, *spark.createDataFrame([], f"{marks_col} array<struct<kind:string,start:int,end:int,stand_in:string>>").schema.fields])
    at = hit_names.index(text_col)
    entity = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("stand_in", pa.string())]))

    def rewrite(batches):
        for b in batches:
            texts, marks = [], []
            for text, new in zip(b.column(at).to_pylist(), b.column(n).to_pylist(), strict=True):
                out, last, mine = [], 0, []
                for e in new:
                    stand_in = shown(e["kind"], e["shown"], e["surrogate"])
                    out += [text[last:e["start"]], stand_in]
                    last = e["end"]
                    mine.append({"kind": e["kind"], "start": e["start"], "end": e["end"], "stand_in": stand_in})
                texts.append("".join([*out, text[last:]]))
                marks.append(mine)
            cols = [pa.array(texts, b.column(i).type) if i == at else b.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(marks, entity)], [*hit_names, marks_col])

    (by,) = C.fresh(hit, "news_row")
    changed = C.map_batches(hit.join(news.withColumnRenamed("news_row", by), F.col(row) == F.col(by)).select(*hit_names, news_col), rewrite, out_kind)
    same = pick(False).select(*hit_names, F.array().cast(out_kind[marks_col].dataType).alias(marks_col))
    both = same.union(changed)
    return both if with_spans else both.select(*hit_names)
