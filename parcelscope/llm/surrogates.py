"""PII surrogates (operator 4), in DataFrame functions alone.

Personal data found by pattern is replaced by made-up data of the same type and
format: letters by letters of the same case, digits by digits, separators kept.
Names after a title, as whole runs of capitalised words with their particles, get a
name of that gender and script; names without a title are not found. What stands for what
comes from a keyed hash of the entity's canonical form, so the same entity gets
the same surrogate in every document and spelling. Surrogates that two entities
would share, or that equal a real entity, are drawn again until all differ.

Defined cases: a null text stays null; texts without personal data are returned
as they are; rows with equal id and text are treated alike; an entity is never
replaced by itself; an empty table gives an empty result; all other columns pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

KEY = "surrogate-key"
#: Draws after which a serial from the hash is appended instead.
DRAWS = 12
#: Draws after which a kind's surrogates count as used up, which is an error.
LAST_DRAW = 64

# Titles by gender, and the patterns of each kind of entity.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "господин"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "госпожа"),
          "n": ("Dr", "Prof", "Professor")}
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
# repetitions without an end are possessive: they neither recurse nor try a run again from each of its places
_PART = "(?:(?:von|van|vom|della|del|der|den|de|di|da|dos|du|la|le|zum|zur|zu|ten|ter|bin|ibn|al|el|[dl]['’]) ?)*+"
_WORD = r"\p{Lu}(?:\.(?= \p{L})|[\p{L}\p{M}]*+(?:['’-][\p{L}\p{M}]++)*+(?![\p{L}\p{M}]))"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,256}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+",
    "iban": r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}0-9])",
    "card": r"(?<![\p{L}0-9])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|[0-9]{13,19})(?![\p{L}0-9])",
    "ip": rf"(?<![\p{{L}}0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}0-9]|\.[0-9])",
    "phone": r"(?:(?<![\p{L}0-9])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
             r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|(?<![\p{L}0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\p{L}0-9])",
    "ssn": r"(?<![\p{L}0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}0-9-])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.?(?: (?:{_TITLE})\.?){{0,3}}(?: {_PART}{_WORD})++",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: No entity is without one of these.
HINT = rf"[0-9@]|(?:{_TITLE})\.? \p{{L}}"
#: Leading letters and digits that tell the type and stay.
KEPT = {"iban": 2, "card": 1, "phone": 1}

# Parts of made-up names, by script.
FIRST = {("latin", "m"): ("Adam", "Bruno", "Conrad", "David", "Emil", "Felix", "Hugo", "Martin"),
         ("latin", "f"): ("Anna", "Bella", "Clara", "Diana", "Elena", "Flora", "Helena", "Maria"),
         ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Павел"),
         ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Зоя", "Ирина", "Нина", "Ольга")}
SYLLABLES = {"latin": ("ba", "den", "far", "gol", "hem", "kir", "lan", "mor", "nel", "par", "ros", "sul", "tam",
                       "vin", "wel", "zor"),
             "cyrillic": ("ба", "вел", "гор", "дан", "зим", "кар", "лев", "мол", "нор", "пол", "рус", "сав", "тим",
                          "фед", "хол", "чер")}


def kind_of(value: Column) -> Column:
    out = None
    for kind in PATTERNS:
        # looking behind and ahead is done by the search; here the kinds' shapes tell them apart
        shape = value.rlike(f"^(?:{PATTERNS[kind]})$")
        out = F.when(shape, F.lit(kind)) if out is None else out.when(shape, F.lit(kind))
    return out


def canonical(kind: Column, value: Column) -> Column:
    """What spellings of one entity have in common."""
    return (F.when(kind == "email", F.lower(F.ltrim(value, F.lit("."))))
            .when(kind == "ip", value)
            .when(kind == "name", F.lower(F.regexp_replace(value, r"\.", "")))
            .otherwise(F.regexp_replace(value, "[^A-Z0-9]", "")))


def _hash(kind: Column, canon: Column, draw: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canon, draw.cast("string")), 256)


def _shaped(value: Column, kept: Column, h: Column) -> Column:
    """``value`` with its letters and digits, but the first ``kept``, taken from the hash."""
    digits = F.translate(h, "abcdef", "012345")
    letters = F.translate(h, "0123456789abcdef", "bcdfghjklmnprstv")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

    def step(a: Column, c: Column) -> Column:
        at = F.pmod(a["i"], F.lit(64)) + 1
        new = (F.when(a["i"] < kept, c)
               .when(c.rlike("[0-9]"), F.substring(digits, at, F.lit(1)))
               .when(c.rlike("[a-z]"), F.substring(letters, at, F.lit(1)))
               .otherwise(F.upper(F.substring(letters, at, F.lit(1)))))
        return (F.when(c.rlike("[A-Za-z0-9]"), F.struct(F.concat(a["out"], new).alias("out"), (a["i"] + 1).alias("i")))
                .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["i"].alias("i"))))
    return F.aggregate(F.split(value, ""), start, step, lambda a: a["out"])


def _byte(h: Column, i: int) -> Column:
    return F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int")


def _pick(options: tuple, h: Column, i: int) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), F.pmod(_byte(h, i), F.lit(len(options))) + 1)


def _name(value: Column, h: Column) -> Column:
    """The title, a first name of its gender if there was one, and a surname, in the name's script."""
    title = F.substring_index(value, " ", 1)
    female = F.regexp_replace(title, r"\.$", "").isin(*TITLES["f"])
    cyrillic = value.rlike(r" \p{IsCyrillic}")

    def first(script: str) -> Column:
        return F.when(female, _pick(FIRST[script, "f"], h, 0)).otherwise(_pick(FIRST[script, "m"], h, 0))

    def last(script: str) -> Column:
        stem = F.concat(*[_pick(SYLLABLES[script], h, i) for i in (1, 2, 3)])
        end = F.when(female, F.lit("ова")).otherwise(F.lit("ов")) if script == "cyrillic" else F.lit("")
        return F.initcap(F.concat(stem, end))
    both = F.size(F.split(value, " ")) > 2
    return F.concat_ws(" ", title, F.when(both, F.when(cyrillic, first("cyrillic")).otherwise(first("latin"))),
                       F.when(cyrillic, last("cyrillic")).otherwise(last("latin")))


def surrogate(kind: Column, canon: Column, value: Column, draw: Column, key: str) -> Column:
    """The replacement of a spelling ``value`` of an entity."""
    h = _hash(kind, canon, draw, key)
    kept = F.coalesce(*[F.when(kind == k, F.lit(n)) for k, n in KEPT.items()], F.lit(0))
    dot = F.length(value) - F.length(F.substring_index(value, ".", -1))
    email = F.concat(_shaped(F.substring(value, F.lit(1), dot), F.lit(0), h), F.substring(value, dot + 1, F.length(value)))
    ip = F.concat_ws(".", (F.pmod(_byte(h, 0), F.lit(223)) + 1).cast("string"),
                     *[_byte(h, i).cast("string") for i in (1, 2, 3)])
    serial = F.when(draw >= DRAWS, F.when(kind == "email", F.concat(F.lit("x"), F.substring(h, 1, 16)))
                    .when(kind == "name", F.concat(F.lit(" "), F.initcap(F.translate(
                        F.substring(h, 1, 16), "0123456789abcdef", "bcdfghjklmnprstv")))))
    return (F.when(kind == "email", F.concat(F.coalesce(serial, F.lit("")), email)).when(kind == "ip", ip)
            .when(kind == "name", F.concat(_name(value, h), F.coalesce(serial, F.lit(""))))
            .otherwise(_shaped(value, kept, h)))


def entities(df: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    """(keep..., k, value, kind, canon): every entity of every text, in order."""
    return (df.filter(F.col(text_col).rlike(HINT))
            .select(*keep, F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0))).alias("k", "value"))
            .withColumn("kind", F.coalesce(kind_of(F.col("value")), F.lit("phone")))
            .withColumn("canon", canonical(F.col("kind"), F.col("value"))))


def redrawn(found: DataFrame, key: str) -> DataFrame:
    """(kind, canon, draw) of the entities whose first draw isn't theirs alone.

    Each round, the smallest entity of each surrogate keeps it, unless it is a
    real entity or was kept in a round before; the others draw again.
    """
    real = cut(found.select("kind", "canon").distinct(), "pii-entities")
    left = real.withColumn("draw", F.lit(0))
    kept = None
    for _ in range(LAST_DRAW):
        made = left.withColumn("s", canonical(F.col("kind"), surrogate(
            F.col("kind"), F.col("canon"), _spelled(F.col("kind"), F.col("canon")), F.col("draw"), key)))
        turn = Window.partitionBy("kind", "s").orderBy("canon")
        taken = real.select("kind", F.col("canon").alias("s"))
        if kept is not None:
            taken = taken.union(kept.select("kind", "s"))
        made = made.join(taken.distinct().withColumn("taken", F.lit(True)), ["kind", "s"], "left")
        made = cut(made.withColumn("ok", F.col("taken").isNull() & (F.row_number().over(turn) == 1))
                   .select("kind", "canon", "draw", "s", "ok"), "pii-draws")
        good = made.filter("ok").select("kind", "canon", "draw", "s")
        kept = good if kept is None else kept.union(good)
        left = made.filter("NOT ok").select("kind", "canon", (F.col("draw") + 1).alias("draw"))
        if not left.limit(1).count():
            return cut(kept.filter("draw > 0").select("kind", "canon", "draw"), "pii-redrawn")
    raise RuntimeError("too few surrogates of these formats: " + ", ".join(
        sorted(r.kind for r in left.select("kind").distinct().collect())))


def _spelled(kind: Column, canon: Column) -> Column:
    """A spelling of a canonical form (names get their capitals back)."""
    return F.when(kind == "name", F.concat(
        F.when(canon.rlike("^г"), F.substring_index(canon, " ", 1)).otherwise(F.initcap(F.substring_index(canon, " ", 1))),
        F.lit(" "), F.initcap(F.substring(canon, F.length(F.substring_index(canon, " ", 1)) + 2, F.length(canon))))
    ).otherwise(canon)


def replace_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY,
                          count_col: str | None = None) -> DataFrame:
    """``df`` with surrogates in its texts; ``count_col`` names an added column
    with the number of entities replaced."""
    at = (F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    found = cut(entities(df, text_col, *at), "pii-found")
    # one row's repeats have the same entities
    once = found.dropDuplicates(["id", "th", "k"])
    drawn = once.join(redrawn(found, key), ["kind", "canon"], "left").withColumn(
        "new", surrogate(F.col("kind"), F.col("canon"), F.col("value"), F.coalesce("draw", F.lit(0)), key))
    per_row = (drawn.groupBy(F.col("id").alias("_id"), F.col("th").alias("_th"))
               .agg(F.array_sort(F.collect_list(F.struct("k", "new"))).alias("_new")))
    text = F.col(text_col)
    has = F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))
    rest = df.filter(~has)
    rows = df.filter(has).select(F.struct(*[F.col(c) for c in df.columns]).alias("_all"), *at)
    joined = rows.join(per_row, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    gaps = F.split(F.col(f"_all.{text_col}"), ANY, -1)
    whole = F.array_join(F.zip_with(gaps, F.concat(F.col("_new.new"), F.array(F.lit(""))),
                                    lambda g, r: F.concat(g, r)), "")
    cols = [whole.alias(c) if c == text_col else F.col(f"_all.{c}").alias(c) for c in df.columns]
    if count_col:
        cols.append(F.size("_new").alias(count_col))
        rest = rest.withColumn(count_col, F.lit(0))
    return rest.unionByName(joined.select(*cols))
