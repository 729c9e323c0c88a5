"""Personal data: generators propose spans, boosted trees decide on those that no base rule vouches for.

Everything runs as DataFrame operations. A pattern's matches and their places come from one split and one extraction of
the same pattern: the lengths of the gaps and matches before a match, summed by a window, give its start. Base
kinds (email, ip, card, phone) are kept as their rules say. Further generators propose overlapping candidates in looser
formats; gradient-boosted trees over format and context features score them, and thresholds calibrated on held-out
documents select. No labelled text is needed: the trees are fitted on spans planted into every document, and on
all of the documents' own candidates that a check outside of the features vouches for or against (check digits, entropy,
a valid number around them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import dropped, keyed_rows, staged

# Java forms of the base patterns. Possessive quantifiers never give back what they took; each gives the
# same matches as the greedy one, since what follows can't start with it. A match can begin inside a run of its first
# class only where the last match ended (\G), which keeps the scan linear.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Formats that the base rules leave out. Candidates of several generators may overlap.
EXTRA = {
    "phone_local": r"(?<![0-9A-Za-z+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "email_words": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._-]*+\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z]{2,10}){1,4}",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z])(?:token|secret|password|passwd|api_key|apikey|access_key)\x20?[=:]\x20?\"?[A-Za-z0-9_+/-]{12,}+",
}
#: What must occur in a text for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "phone_local": None, "email_words": "at", "national_id": "-", "iban": None, "secret": None}
KINDS = [*BASE, *EXTRA]
ORDER = {k: i for i, k in enumerate(KINDS)}
CONTEXT = 32
#: Words before or after a candidate that speak for or against personal data.
FOR = r"(?i)call|phone|tel|mobile|fax|mail|contact|write|ssn|social|identity|iban|account|bank|transfer|token|secret|password|key|login"
AGAINST = r"(?i)order|invoice|part|isbn|version|ticket|item|model|serial|page|chapter|lot|figure|placeholder|example|sample"
#: Code points around a place at which spans are planted.
SLICE = 240
#: Documents below which there are too few to hold some out.
FEW_DOCS = 30
#: Planted spans at least (where there are fewer documents, each gets several; else each gets one), trees and their depth.
EXAMPLES, TREES, DEPTH = 3000, 15, 5
#: Bits a character of a value up to which it is a filler and from which it is a secret; between them nothing vouches.
FILLER_ENTROPY, SECRET_ENTROPY = 1.5, 3.0
LEAST_PRECISION = 0.98

FEATURES = ["kind_code", "length", "digits", "letters", "uppers", "separators", "groups", "distinct_digits", "for_words", "against_words", "glued_before", "glued_after"]


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, index, gap length, match, context before, context after) of a pattern's matches."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.transform(
        found,
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(gaps[i]).alias("gap"),
            m.alias("match"),
            F.right(gaps[i], F.lit(CONTEXT)).alias("before"),
            F.left(gaps[i + 1], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return rows


def _present(text: Column, kind: str) -> Column:
    need = F.lit(True) if NEEDS[kind] is None else F.contains(text, F.lit(NEEDS[kind]))
    if kind in ("email", "email_words"):
        return need
    return need & (F.rlike(text, F.lit(r"[0-9]")) if kind != "secret" else F.rlike(text, F.lit(r"[=:]")))


def candidates(rows: DataFrame) -> DataFrame:
    """``rows``: ``__id, __th, __text``. All matches: ``__id, __th, kind, start, end, match, before, after``, once a text."""
    text = F.col("__text")
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,match:string,before:string,after:string>>")
    parts = [F.when(_present(text, k), _matches(text, k, p)).otherwise(none) for k, p in (BASE | EXTRA).items()]
    found = rows.select("__id", "__th", F.explode(F.concat(*parts)).alias("m")).select("__id", "__th", "m.*")
    found = found.dropDuplicates(["__id", "__th", "kind", "i"])
    order = Window.partitionBy("__id", "__th", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(order)
    return found.withColumn("end", end).withColumn("start", F.col("end") - F.length("match")).select("__id", "__th", "kind", "start", "end", "match", "before", "after")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the Luhn check."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(19):
        d = F.substring(padded, 19 - i, 1).cast("int")
        total = total + (d if i % 2 == 0 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def base_valid() -> Column:
    """Whether a base match passes its kind's test; null for other kinds."""
    digits = _digits(F.col("match"))
    small = F.forall(F.split("match", "\\."), lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3) & (F.coalesce(F.nullif(F.right(F.concat(F.lit("0"), F.ltrim(part, F.lit("0"))), F.lit(3)), F.lit("")).cast("int"), F.lit(0)) <= 255))
    card = F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    return F.when(F.col("kind") == "email", True).when(F.col("kind") == "ip", small).when(F.col("kind") == "card", card).when(F.col("kind") == "phone", F.length(digits).between(9, 15))


def with_features(found: DataFrame) -> DataFrame:
    count = lambda what: F.length("match") - F.length(F.regexp_replace("match", what, ""))
    code = reduce(lambda c, k: c.when(F.col("kind") == k, float(ORDER[k])), KINDS, F.when(F.lit(False), 0.0))
    near = F.concat_ws(" ", "before", "after")
    return found.withColumns(
        {
            "kind_code": code,
            "length": F.length("match").cast("double"),
            "digits": count("[0-9]").cast("double"),
            "letters": count("[A-Za-z]").cast("double"),
            "uppers": count("[A-Z]").cast("double"),
            "separators": count("[^0-9A-Za-z]").cast("double"),
            "groups": F.size(F.split("match", "[^0-9A-Za-z]+")).cast("double"),
            "distinct_digits": F.size(F.array_distinct(F.split(F.regexp_replace("match", "[^0-9]", ""), ""))).cast("double"),
            "for_words": F.regexp_count(near, F.lit(FOR)).cast("double"),
            "against_words": F.regexp_count(near, F.lit(AGAINST)).cast("double"),
            "glued_before": F.rlike("before", F.lit("[0-9A-Za-z_/#-]$")).cast("double"),
            "glued_after": F.rlike("after", F.lit("^[0-9A-Za-z_/-]")).cast("double"),
        }
    )


#: Words that introduce planted spans: for each kind those before real ones and before look-alikes, for the fitted and for the held-out folds.
CUES = {
    "phone_local": [["call me at ", "my phone: ", "mobile ", ""], ["order ", "invoice ", "part no ", "item "], ["tel ", "reach me, contact ", "fax ", ""], ["ticket ", "serial ", "lot "]],
    "email_words": [["mail ", "write to ", ""], ["see example ", "placeholder "], ["contact ", ""], ["a sample "]],
    "national_id": [["ssn ", "social number "], ["part ", "version "], ["identity no ", "my ssn is "], ["serial ", "figure "]],
    "iban": [["iban ", "transfer to ", ""], ["serial ", "model "], ["bank account ", ""], ["part ", "item "]],
    "secret": [["my ", "the ", "login ", ""], ["example ", "my ", ""], ["use ", ""], ["placeholder ", "the ", ""]],
}


def entropy(text: Column) -> Column:
    """Bits a character of a text, from the shares of its characters."""
    chars = F.split(text, "")
    return -F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s + (lambda p: p * F.log2(p))(F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)))


def mod97(text: Column) -> Column:
    """The rest of an account number (IBAN) by 97, its first four characters last and letters as numbers from 10: 1 if it is valid."""
    compact = F.regexp_replace(text, "[^A-Z0-9]", "")
    moved = F.split(F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4))), "")
    return F.aggregate(moved, F.lit(0), lambda r, c: F.when(c.rlike("[A-Z]"), (r * 100 + F.ascii(c) - 55) % 97).otherwise((r * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97))


def contexts(rows: DataFrame) -> DataFrame:
    """The stored table ``key, fold, left, right``: a place in each document that is not empty, with the text around it."""
    text = F.col("__text")
    hashed = lambda salt: F.xxhash64("__id", "__th", F.lit(salt))
    at = F.pmod(hashed(1), F.greatest(F.length(text) - SLICE + 1, F.lit(1))).cast("int") + 1
    cut = rows.where(F.length(text) > 0).select(hashed(2).alias("key"), F.substr(text, at, F.lit(SLICE)).alias("slice"))
    words = F.split("slice", r"(?<=\s)")
    half = F.floor(F.size(words) / 2).cast("int")
    places = cut.select("key", F.array_join(F.slice(words, F.lit(1), half), "").alias("left"), F.array_join(F.slice(words, half + 1, F.size(words)), "").alias("right"))
    return staged(places.withColumn("fold", F.pmod("key", F.lit(3))), "contexts")


def planted(places: DataFrame) -> DataFrame:
    """``__id, __text, kind, at, label, fold``: a span of a further kind, or a look-alike of it, at each place; digits come from hashes.

    With EXAMPLES places or more each has one, the kind by its hash; with fewer each has all kinds.
    Folds are those of the documents (with fewer than FEW_DOCS of them, of the examples), and the held-out one has other introducing words
    than the fitted ones."""
    spark = places.sparkSession
    kinds = [(k, good) for k in EXTRA for good in (True, False)]
    if places.isEmpty():
        places = spark.range(3).select("id", F.lit("").alias("left"), F.lit("").alias("right")).select(F.col("id").alias("key"), "left", "right", F.col("id").alias("fold"))
    n = places.count()
    again = max(1, -(-EXAMPLES // (n * len(kinds))))
    rows = places.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(again))))
    rows = rows if n >= FEW_DOCS else rows.withColumn("fold", F.pmod("again", F.lit(3)))
    rows = rows.withColumn("which", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(len(kinds))).cast("int") if n >= EXAMPLES else F.explode(F.sequence(F.lit(0), F.lit(len(kinds) - 1))))
    rows = rows.withColumn("id", F.xxhash64("key", "again", "which"))
    d = lambda salt, size: F.lpad((F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10**size))).cast("string"), size, "0")
    pick = lambda salt, values: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(values))) + 1).cast("int"))
    word = lambda salt: pick(salt, ["anna", "river", "stone", "lima", "oslo", "berg", "nilo", "tara"])
    size = F.when(F.pmod("id", F.lit(4)) == 0, 40 + F.pmod("id", F.lit(400))).otherwise(16 + F.pmod("id", F.lit(25))).cast("int")
    hexed = F.left(F.concat(*(F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(7))), size)
    groups = lambda n: F.concat(*(F.concat(F.lit(" "), d(10 + i, 4)) for i in range(n)))
    country = pick(5, ["DE", "FR", "ES"])
    # The check digits that make the number's rest by 97 one.
    check = F.lpad((98 - mod97(F.concat(country, F.lit("00"), groups(5)))).cast("string"), 2, "0")
    name = F.concat(pick(5, ["token", "secret", "api_key", "password"]), pick(8, [" = ", ": ", "="]))
    spans = {
        "phone_local": [F.when(F.pmod("id", F.lit(2)) == 0, F.concat(F.lit("("), d(2, 3), F.lit(") "), d(3, 3), F.lit("-"), d(4, 4))).otherwise(F.concat(d(2, 3), pick(5, ["-", ".", " "]), d(3, 3), F.lit("-"), d(4, 4))), F.concat(d(2, 3), pick(5, ["-", "."]), d(3, 3), pick(6, ["-", "."]), d(4, 4))],
        "email_words": [F.concat(word(6), F.lit(" [at] "), word(7), F.lit(" [dot] com"))] * 2,
        "national_id": [F.concat(d(2, 3), F.lit("-"), d(3, 2), F.lit("-"), d(4, 4))] * 2,
        "iban": [F.concat(country, check, groups(5)), F.concat(pick(5, ["AB", "XK", "QQ"]), d(2, 2), groups(3))],
        "secret": [F.concat(name, F.lit('"'), hexed), F.concat(name, F.left(F.repeat(pick(9, ["x", "ab", "your", "change", "_-"]), F.lit(450)), size))],
    }
    pairs = lambda f: reduce(lambda c, i: c.when(F.col("which") == i, f(*kinds[i])), range(1, len(kinds)), F.when(F.col("which") == 0, f(*kinds[0])))
    fitted = F.col("fold") < 2
    rows = rows.withColumns({"kind": pairs(lambda k, good: F.lit(k)), "label": pairs(lambda k, good: F.lit(float(good))), "span": pairs(lambda k, good: spans[k][0 if good else 1]), "cue": pairs(lambda k, good: F.when(fitted, pick(1, CUES[k][0 if good else 1])).otherwise(pick(1, CUES[k][2 if good else 3])))})
    text = F.concat("left", "cue", "span", pick(21, [" ", ". ", ", "]), "right")
    return rows.select(F.col("id").alias("__id"), text.alias("__text"), "kind", (F.length("left") + F.length("cue")).alias("at"), "label", F.col("fold").cast("long").alias("fold"))


def vouched(found: DataFrame) -> DataFrame:
    """Candidates of the documents themselves with a label that a check gives which the trees' features don't hold: ``kind, label, fold`` and the candidate.

    A local number inside of a valid international one is a phone number, an account number whose rest by 97 is right is one (another may be mistyped: no label), and a secret is told
    from a filler by the entropy of its value."""
    own = found.where(F.col("kind").isin(*EXTRA))
    phones = found.where(F.col("kind") == "phone").where(base_valid()).select(F.col("__id").alias("p_id"), F.col("__th").alias("p_th"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    inside = (F.col("kind") == "phone_local") & F.col("__id").eqNullSafe(F.col("p_id")) & (F.col("__th") == F.col("p_th")) & (F.col("start") >= F.col("p_start")) & (F.col("end") <= F.col("p_end"))
    value = F.regexp_extract("match", r"([A-Za-z0-9_+/-]*)$", 1)
    label = F.when((F.col("kind") == "secret") & (entropy(value) >= SECRET_ENTROPY), True).when((F.col("kind") == "secret") & (entropy(value) <= FILLER_ENTROPY), False).when((F.col("kind") == "iban") & (mod97(F.col("match")) == 1), True)
    local = own.join(phones, inside, "left_semi").withColumn("label", F.lit(1.0))
    others = own.where(F.col("kind").isin("secret", "iban")).withColumn("label", label.cast("double"))
    return local.unionByName(others).where("label is not null").withColumn("fold", F.pmod(F.xxhash64("__id", "__th", F.lit(2)), F.lit(3)))


def fit(rows: DataFrame, found: DataFrame) -> tuple[GBTClassificationModel, dict[str, float]]:
    """The trees, and for each extra kind the least score that keeps the precision on the held-out documents.

    Examples are spans planted into documents and the documents' own candidates that a check vouches for or against. ``rows`` has ``__id, __th, __text``, ``found`` their
    candidates; two of three documents are fitted on, the third calibrates."""
    made = staged(planted(contexts(rows)), "planted")
    own = candidates(made.select("__id", F.lit(b"").alias("__th"), "__text")).join(made.select("__id", "kind", "at", "label", "fold"), ["__id", "kind"]).where("start = at")
    columns = ["kind", "match", "before", "after", "label", "fold"]
    table = own.select(columns).unionByName(vouched(found).select(columns))
    # Examples alike in all features are one row, weighted by their number.
    alike = with_features(table).groupBy("kind", "label", "fold", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    table = staged(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(alike).select("kind", "label", "fold", "weight", "features"), "examples")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, labelCol="label", weightCol="weight", cacheNodeIds=False, checkpointInterval=-1).fit(table.where("fold < 2"))
    scored = model.transform(table.where("fold = 2")).select("kind", "label", "weight", F.round(vector_to_array("probability")[1], 6).alias("p"))
    scored = scored.groupBy("kind", "p").agg(F.sum("weight").alias("all"), F.sum(F.col("label") * F.col("weight")).alias("right"))
    falling = Window.partitionBy("kind").orderBy(F.col("p").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    precise = scored.withColumn("precision", F.sum("right").over(falling) / F.sum("all").over(falling)).select("kind", "p", "precision")
    # The threshold lies in the middle between the lowest score that is precise enough and the next one below it.
    precise = precise.withColumn("lower", F.coalesce(F.lag("p").over(Window.partitionBy("kind").orderBy("p")), F.lit(0.0))).where(F.col("precision") >= LEAST_PRECISION)
    got = {r["kind"]: (r["t"]["p"] + r["t"]["lower"]) / 2 for r in precise.groupBy("kind").agg(F.min(F.struct("p", "lower")).alias("t")).collect()}  # a row a kind
    dropped(made, table)
    return model, {k: max(got.get(k, 1.1), 0.5) for k in EXTRA}


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id, __th, kind, start, end, base``: base spans and the selected further ones, in code points, end exclusive."""
    rows = _rows(docs, id_col, text_col)
    found = staged(candidates(rows), "candidates")
    model, thresholds = fit(rows, found)
    base = found.where(F.col("kind").isin(*BASE)).where(base_valid()).select("__id", "__th", "kind", "start", "end", F.lit(True).alias("base"))
    extra = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(found.where(F.col("kind").isin(*EXTRA))))
    least = reduce(lambda c, k: c.when(F.col("kind") == k, thresholds[k]), EXTRA, F.when(F.lit(False), 2.0)).otherwise(2.0)
    chosen = model.transform(extra).where(F.round(vector_to_array("probability")[1], 6) >= least)
    return base.unionByName(chosen.select("__id", "__th", "kind", "start", "end", F.lit(False).alias("base")))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed_rows(docs, id_col, text_col).select("__id", F.col("__tie").alias("__th"), "__text")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Counts and digest are of the base spans, ``spans`` of all, each ``kind:start:end`` in order of start, then kind. Null texts count
    as empty and have none. Rows that share an id are judged on their own text.
    """
    rank = reduce(lambda c, k: c.when(F.col("kind") == k, ORDER[k]), KINDS, F.when(F.lit(False), 0))
    entry = F.struct("start", rank.alias("rank"), "end", F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("text"), "base")
    per = personal_spans(docs, id_col, text_col).groupBy("__id", "__th").agg(F.array_sort(F.collect_list(entry)).alias("all"), *(F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in BASE))
    per = staged(per.select(F.col("__id").alias("__pid"), F.col("__th").alias("__pth"), *(f"n_{k}" for k in BASE), F.array_join(F.transform(F.filter("all", lambda s: s["base"]), lambda s: s["text"]), ",").alias("base"), F.array_join(F.transform("all", lambda s: s["text"]), ",").alias("spans")), "spans")
    rows = _rows(docs, id_col, text_col).select("__id", "__th")
    joined = rows.join(per, F.col("__id").eqNullSafe(F.col("__pid")) & (F.col("__th") == F.col("__pth")), "left")
    return joined.select(F.col("__id").alias(id_col), *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each selected span replaced by its kind in brackets; of overlapping spans the longest at a place wins.

    Rows without spans are unchanged, null texts stay null. Rows that share an id, or have none, are judged by their own text.
    """
    spans = personal_spans(docs, id_col, text_col).groupBy("__id", "__th").agg(F.array_sort(F.collect_list(F.struct("start", (-F.col("end")).alias("stop"), "kind"))).alias("spans"))
    spans = spans.select(F.col("__id").alias("__sid"), "__th", "spans")
    joined = keyed_rows(docs, id_col, text_col, whole=True).join(spans, F.col("__id").eqNullSafe(F.col("__sid")) & (F.col("__tie") == F.col("__th")), "left")
    text = F.col("__text")
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"), (-s["stop"]).cast("int").alias("at")))
    done = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    own = lambda c: F.col("__row")[c]
    return joined.select(*(F.when(F.col("spans").isNull(), own(c)).otherwise(done).alias(c) if c == text_col else own(c).alias(c) for c in docs.columns))
