"""Personal data: surrogates that keep type, form, gender and script.

Entities are found by patterns: e-mail addresses, phone numbers, IPv4
addresses, payment card numbers (with a right check digit), US social security
numbers, and names after a form of address and wherever they come again in the
text.  A run of digits in groups is a card, or else what its parts are (so a
telephone number beside another number is found; a date stays).  Each mention has a key (digits
only, lower case) that is equal for equal entities however they are written,
so coreference holds within and between texts.

A surrogate is drawn from a keyed hash (HMAC) of kind and key: digits for digits
(check digits hold, octets stay in range), invented names of the same gender
and script for names, an invented mailbox at a reserved domain for e-mails.
Then collisions are checked over all entities: where two keys drew the same
surrogate, or a surrogate is the key of another entity, all but the least key
draw again.  So different entities have different surrogates.  Each mention is
then written in its own form: separators, brackets and capitals stay.

Texts without a character that any pattern needs never leave the scan.  Others
are written once with their mentions; keys and surrogates are joined by key,
and brought together by row, so a frequent entity is one row of the table.

Defined cases: null and empty texts stay as they are.  Repeated rows get equal
texts.  Null ids and extra columns pass through.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_right
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship, stored

ship(__name__)

# --- fixed values -----------------------------------------------------------
TITLES = {
    "m": "Mr Mister Herr Monsieur Señor Sr Don господин Κύριος",
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Mme Señora Señorita Sra Doña госпожа Κυρία",
    "n": "Dr Prof Professor",
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo",
    "cyrillic": "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви во",
    "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το",
}
ENDINGS = {"latin": {"m": "us", "f": "a", "n": "en"}, "cyrillic": {"m": "ов", "f": "ова", "n": "ко"}, "greek": {"m": "ος", "f": "α", "n": "ι"}}
SURROGATE_DOMAIN = "surrogate.invalid"
# ----------------------------------------------------------------------------

KEY = b"folio surrogate key"   # a parameter: whoever holds it can redo the mapping
MAX_DRAWS = 64
GATE = r"@|[0-9]{3}-[0-9]{2}-|[0-9][0-9 ().\-]{5,}[0-9]|(?<![\p{L}\p{N}_])(?:" + "|".join(" ".join(TITLES.values()).split()) + r")(?![\p{L}\p{N}_])"

_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_PHONE = r"(?P<phone>(?<![\w(+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)|(?<!\w)\+\d{1,3}(?:[ .-]?\d){7,12}(?!\w))"
_SSN = r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
#: What a run of digits can hold: cards as they are written, dates (which stay), telephone and social security numbers.
_IN_RUN = re.compile(r"(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<by>[ -])\d{4}(?P=by)\d{4}(?P=by)\d{4}(?P<tail>(?P=by)\d{1,3})?|\d{4}(?P<of>[ -])\d{6}(?P=of)\d{4,5})(?!\w))"
                     r"|(?P<date>(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-]))|" + _PHONE + "|" + _SSN)
_PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d))"
    r"|(?P<run>(?<![\w-])\d(?:[ -]?\d){12,}(?![\w-]))"
    r"|" + _PHONE + "|" + _SSN +
    r"|(?P<person>(?<!\w)(?:" + "|".join(" ".join(TITLES.values()).split()) + r")\.?\x20(?P<name>" + _NAME + r"(?:\x20" + _NAME + r")?))")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts.split()}


def _luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _in_run(text: str, lo: int, hi: int) -> list[tuple[int, int, str, str]]:
    """Entities of a run of digits in groups: one card, or what its parts are."""
    found, at, plain = [], lo, True
    while (m := _IN_RUN.search(text, at)) and m.start() < hi:
        kind, end = "card" if m["card"] else m.lastgroup, m.end()
        if kind == "card" and m["tail"] and _luhn(re.sub(r"\D", "", text[m.start():m.start("tail")])):
            end = m.start("tail")   # sixteen digits, and another number beside them
        key = re.sub(r"\D", "", text[m.start():end])
        if kind == "card" and not _luhn(key):
            at = m.start() + 1      # something else may begin inside
            continue
        plain = plain and kind == "card"
        if kind != "date":
            found.append((m.start(), end, kind, key))
        at = end
    digits = re.sub(r"\D", "", text[lo:hi])
    if not found and plain and 13 <= len(digits) <= 19 and _luhn(digits):
        return [(lo, hi, "card", digits)]
    return found


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, key) of the entities of a text, in order and apart.

    A person is found behind a title; the words of that name count wherever else
    they stand with a capital in the text.
    """
    text, out, at = text or "", [], 0
    names: dict[str, str] = {}
    while m := _PATTERN.search(text, at):
        kind, (lo, hi) = m.lastgroup, m.span()
        at = hi
        if m["name"]:
            gender = _GENDER[re.match(r"\w+", m[0])[0]]
            begin = m.start("name")
            for k, word in enumerate(re.finditer(_NAME, m["name"])):
                if not word[0][0].isupper():
                    break
                whole = m["name"].count(" ") == 0
                role = "surname" if k or whole else "given"   # a surname alone meets the one after a given name
                kind = f"{role}:{gender if role == 'given' else 'n'}:{_script(word[0])}"
                out.append((begin + word.start(), begin + word.end(), kind, word[0].casefold()))
                if len(word[0]) > 1:
                    names.setdefault(word[0].casefold(), kind)
        elif kind == "run":
            found = _in_run(text, lo, hi)
            out += found
            at = max([hi, *(f[1] for f in found)])
        else:
            out.append((lo, hi, kind, m[0].lower() if kind == "email" else m[0] if kind == "ip" else re.sub(r"\D", "", m[0])))
    if names:
        taken = {f[0] for f in out}
        spans = sorted((lo, hi) for lo, hi, *_ in out)
        begins = [lo for lo, _ in spans]
        for word in re.finditer(_NAME, text):
            lo, key = word.start(), word[0].casefold()
            before = bisect_right(begins, lo) - 1
            if key in names and word[0][0].isupper() and lo not in taken and (before < 0 or spans[before][1] <= lo):
                out.append((lo, word.end(), names[key], key))
        out.sort()
    return out


def draw(kind: str, key: str, turn: int, secret: bytes = KEY) -> str:
    """Surrogate of a key; another one each turn."""
    pool = int.from_bytes(hmac.new(secret, f"{kind}\0{key}\0{turn}".encode(), hashlib.sha512).digest(), "big")

    def take(n: int) -> int:
        nonlocal pool
        pool, r = divmod(pool, n)
        return r

    if kind == "ip":
        return ".".join(str(x) for x in (1 + take(223), take(256), take(256), 1 + take(254)))
    if kind == "card":
        body = key[0] + "".join(str(take(10)) for _ in key[2:])
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    if kind in ("phone", "ssn"):
        plain = max(0, len(key) - 10)       # a country code stays
        return key[:plain] + "".join(str(2 + take(8)) if i == 0 else str(take(10)) for i in range(len(key) - plain))
    role, _, rest = kind.partition(":")
    gender, _, script = rest.partition(":")
    syllables = SYLLABLES[script or "latin"].split()
    name = "".join(syllables[take(len(syllables))] for _ in range(2 + min(turn, 8) + (role == "email")))
    if role == "email":
        return f"{name}.{take(10 ** 6):06d}@{SURROGATE_DOMAIN}"
    return name + ENDINGS[script][gender]


def written(kind: str, mention: str, surrogate: str) -> str:
    """A surrogate in the form of one mention."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(surrogate)
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if ":" in kind:
        return surrogate.upper() if mention.isupper() and len(mention) > 1 else surrogate.capitalize()
    return surrogate


def _find(place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string()), ("key", pa.string())]))
        for b in batches:
            found = [[dict(zip(("s", "e", "kind", "key"), m)) for m in mentions(t.as_py())] for t in b.column(place)]
            ids = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, ids, pa.array(found, kind)], names=[*b.schema.names, "row_", "found_"])
    return run


def _draw_all(turn: int, secret: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [draw(k, x, turn, secret) for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["kind", "key", "surrogate"])
    return run


def surrogates(entities: DataFrame, secret: bytes = KEY) -> DataFrame:
    """(kind, key) -> surrogate, all different within a kind of value, and none a key."""
    space = F.split("kind", ":")[0]     # given names and surnames of any gender must differ as written
    left, done = entities, None
    for turn in range(MAX_DRAWS):
        drawn = stored(left.mapInArrow(_draw_all(turn, secret), "kind string, key string, surrogate string"), "pii-drawn").withColumn("space", space)
        best = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "key")).alias("first"))
        taken = entities.select(space.alias("space"), F.col("key").alias("surrogate")).distinct()
        won = best.join(taken, ["space", "surrogate"], "left_anti")
        if done is not None:
            won = won.join(done.select(space.alias("space"), "surrogate"), ["space", "surrogate"], "left_anti")
        won = won.select("first.kind", "first.key", "surrogate")
        done = stored(won if done is None else done.unionAll(won), "pii-done")
        left = stored(drawn.select("kind", "key").join(done, ["kind", "key"], "left_anti"), "pii-left")
        if left.isEmpty():
            return done
    raise ValueError("there are more entities of a kind than surrogates of its form")


def _rewrite(place: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, found, maps = (b.column(names.index(n)).to_pylist() for n in (names[place], "found_", "map_"))
            out = []
            for text, ms, pairs in zip(texts, found, maps):
                if ms:
                    to = {(p["kind"], p["key"]): p["surrogate"] for p in pairs}
                    parts, at = [], 0
                    for m in ms:
                        parts += [text[at:m["s"]], written(m["kind"], text[m["s"]:m["e"]], to[m["kind"], m["key"]])]
                        at = m["e"]
                    text = "".join(parts) + text[at:]
                out.append(text)
            cols = [c for c, n in zip(b.columns, names) if n not in ("row_", "found_", "map_")]
            cols[place] = pa.array(out, pa.string())
            count = pa.array([len(ms or ()) for ms in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*cols, count], names=[*[n for n in names if n not in ("row_", "found_", "map_")], "n_replaced"])
    return run


def replace(docs: DataFrame, text: str = "text", secret: bytes = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_replaced`` (long)."""
    names = docs.columns
    plain = in_small_batches(docs).toDF(*[f"c{i}" for i in range(len(names))])     # clashing names cannot meet
    place = names.index(text)
    t = f"c{place}"
    some = F.coalesce(F.col(t).rlike(GATE), F.lit(False))
    kind = "array<struct<s:int,e:int,kind:string,key:string>>"
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    found = stored(plain.where(some).mapInArrow(_find(place), f"{ddl}, row_ long, found_ {kind}"), "pii-found")
    each = found.select("row_", F.explode("found_").alias("m")).select("row_", "m.kind", "m.key").distinct()
    table = surrogates(stored(each.select("kind", "key").distinct(), "pii-entities"), secret)
    maps = each.join(table, ["kind", "key"]).groupBy("row_").agg(F.collect_list(F.struct("kind", "key", "surrogate")).alias("map_"))
    joined = found.join(maps, "row_", "left").select(*plain.columns, "row_", "found_", "map_")
    new = joined.mapInArrow(_rewrite(place, joined.columns), f"{ddl}, n_replaced long")
    out = plain.where(~some).withColumn("n_replaced", F.lit(0).cast("long")).unionAll(new)
    kept = [i for i, n in enumerate(names) if n.lower() != "n_replaced"]
    return out.select(*[F.col(f"c{i}").alias(names[i]) for i in kept], "n_replaced")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return replace(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "n_replaced", "text")
