"""Personal data: regular-expression candidates, boosted trees and calibrated thresholds, without Python code in tasks."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimworks.llm.common import stored, table

STRATUM = 1250  # weight at most of all candidates of one kind, pattern set and label together, in the trees
CONTEXT = 24  # code points kept on either side of a candidate
PRECISION = 0.95  # asked of added spans on the calibrating part of the sample
PRIOR_LIMIT, PRIOR_WEIGHT = 0.8, 20  # threshold that holds without calibrating candidates, and for how many it counts

KINDS = ["email", "ip", "card", "phone"]

# The base patterns.  Quantifiers are possessive, and a run is entered only at its start or where
# the last match ended, where that changes no match; long runs then cost linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What the base patterns miss, proposed generously; the trees decide.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?: ?[\[(] ?at ?[\])] ?| at )[a-z0-9-]{1,63}"
             r"(?:(?: ?[\[(] ?dot ?[\])] ?| dot |\.)[a-z0-9-]{2,24}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\(?[0-9]{2,4}\)?[ .-]){2,4}[0-9]{3,4}(?![0-9])",
}
HINTS = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|addr|server",
    "card": r"(?i)card|visa|credit|pay|account",
    "phone": r"(?i)phone|tel|call|fax|mobile|contact",
}

#: Endings of domain names by which a spelled-out address is told from prose.
ENDINGS = (
    "com|org|net|edu|gov|mil|int|info|biz|io|dev|app|ai|co|me|tv|eu|us|uk|de|fr|es|it|nl|be|ch|at|pl|cz|se|no|dk|fi|pt|ie|gr|"
    "hu|ro|ru|ua|tr|il|in|cn|jp|kr|tw|hk|sg|au|nz|ca|mx|br|ar|cl|za|test|example"
)
# Fixed examples (kind, value, text before, label), so that trees can be fitted on any table, however small.
EXAMPLES = [
    (kind, value, before, label)
    for kind, before, label, values in [
        ("email", "write to ", 1, ["jane.roe [at] mail [dot] org", "k_lee(at)example(dot)com", "info [at] shop.de", "bob7 at post dot net",
                                   "a.b (at) uni.edu", "mia99 at web.de"]),
        ("email", "it is ", 0, ["available at github.com", "look at home.Then", "stay at work.We", "arrived at noon.The", "met at last.It",
                                "sold at shops.com"]),
        ("ip", "from ", 1, ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80:0:0:0:202:b3ff:fe1e:8329", "2a02:8108:1:2:3:4:5:6"]),
        ("ip", "at ", 0, ["12:30:45:10", "00:1a:2b:3c:4d:5e", "1:2:3:4", "10:20:30:40:50"]),
        ("card", "card ", 1, ["4111.1111.1111.1111", "5500/0000/0000/0004", "4012_8888_8888_1881"]),
        ("card", "number ", 0, ["1234.5678.9012.3456", "2001/2002/2003/2004", "1000_2000_3000_4000"]),
        ("phone", "call ", 1, ["(212) 555 0147", "212-555-0147", "030 1234 5678", "(089) 123 4567", "415.555.0199"]),
        ("phone", "in ", 0, ["2010 2011 2012", "01.02.2003 1200", "100 200 300", "1999-2000 2001", "10 20 30 400"]),
    ] for value in values
]


def proposals(text: Column, kind: str, loose: bool) -> Column:
    """Matches of one pattern as an array: number, value, code points since the last match, context."""
    pattern = (LOOSE if loose else BASE)[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rest = F.split(text, pattern, -1)
    return F.transform(
        F.arrays_zip(
            found.alias("value"),
            F.transform(F.slice(rest, 1, F.greatest(F.size(rest) - 1, F.lit(0))), lambda x: F.struct(
                F.length(x).alias("gap"), F.right(x, F.lit(CONTEXT)).alias("before"))).alias("left"),
            F.transform(F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))), lambda x: F.substring(x, 1, CONTEXT)).alias("after"),
        ),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(loose).alias("loose"), i.alias("i"), z["value"].alias("value"),
            z["left"]["gap"].alias("gap"), z["left"]["before"].alias("before"), z["after"].alias("after"),
        ),
    )


def luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string of at most 19 digits holds."""
    def value(i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i))
    return F.when(F.length(digits).between(1, 19), total % 10 == 0).otherwise(F.lit(False))


def sound() -> Column:
    """What the base rules ask of a match beyond its pattern."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    part = F.transform(F.split("value", r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(part, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(False))
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", n.between(13, 19) & luhn(digits))
        .otherwise(n.between(9, 15))
    )


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One written row per match of any pattern, one at least per document: rid, key, digest of the text, span.

    The texts are read once; only matches with a little context are kept.  Positions are running sums of
    the pieces between matches, over the matches of one document and pattern.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), body.alias("t"))
    none = F.array().cast("array<struct<kind:string,loose:boolean,i:int,value:string,gap:int,before:string,after:string>>")
    digit = F.col("t").rlike("[0-9]")
    parts = [
        F.when(F.col("t").contains("@"), proposals(F.col("t"), "email", False)).otherwise(none),
        *(F.when(digit, proposals(F.col("t"), kind, False)).otherwise(none) for kind in ("ip", "card")),
        F.when(F.col("t").contains("+"), proposals(F.col("t"), "phone", False)).otherwise(none),
        proposals(F.col("t"), "email", True),
        F.when(F.col("t").contains(":"), proposals(F.col("t"), "ip", True)).otherwise(none),
        *(F.when(digit, proposals(F.col("t"), kind, True)).otherwise(none) for kind in ("card", "phone")),
    ]
    flat = rows.select("rid", "key", F.md5("t").alias("digest"), F.explode_outer(F.concat(*parts)).alias("m")).select(
        "rid", "key", "digest", "m.*"
    )
    written = stored(flat, "pii")
    so_far = Window.partitionBy("rid", "kind", "loose").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far).cast("long")
    placed = written.where("kind is not null").select("*", end.alias("stop"))
    placed = placed.withColumn("start", F.col("stop") - F.length("value"))
    # a written row of each document stands for it even if it holds nothing
    empty = written.where("kind is null").withColumn("stop", F.lit(None).cast("long")).withColumn("start", F.lit(None).cast("long"))
    return placed.unionByName(empty.select(placed.columns))


YEAR = r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"
FORMAT = ["n_chars", "n_marks", "n_letters", "digit_share", "distinct_chars", "groups", "first_zero", "brackets", "blanks", "dots", "years", "proposed"]
CONTEXTS = ["hint", "before_letter", "before_digit", "before_mark", "after_letter", "after_digit", "after_mark"]


INPUTS = FORMAT + CONTEXTS + [f"is_{k}" for k in KINDS]


def measured(rows: DataFrame) -> DataFrame:
    """Format and context features of candidates; no count of digits and no check sum is among them."""
    value = F.col("value")
    n = F.length("value")
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(value, r"[^\p{L}]", ""))
    hint = F.lit(False)
    for kind, words in HINTS.items():
        hint = F.when(F.col("kind") == kind, F.col("before").rlike(words)).otherwise(hint)
    last, first = F.right("before", F.lit(1)), F.substring("after", 1, 1)
    out = rows.select(
        "*", n.alias("n_chars"), letters.alias("n_letters"), (n - digits - letters).alias("n_marks"),
        (digits / n).alias("digit_share"), F.size(F.array_distinct(F.split(value, ""))).alias("distinct_chars"),
        F.size(F.split(value, "[^0-9]+")).alias("groups"), value.startswith("0").cast("int").alias("first_zero"),
        *(F.length(F.regexp_replace(value, f"[^{c}]", "")).alias(name) for c, name in ((r"\[\]()", "brackets"), (" ", "blanks"), (".", "dots"))),
        F.size(F.regexp_extract_all(value, F.lit(YEAR), F.lit(0))).alias("years"), F.col("loose").cast("int").alias("proposed"),
        hint.cast("int").alias("hint"),
        *(c.rlike(p).cast("int").alias(f"{side}_{name}") for side, c in (("before", last), ("after", first))
          for name, p in (("letter", r"\p{L}"), ("digit", "[0-9]"), ("mark", r"[^\p{L}0-9\s]"))),
        *((F.col("kind") == k).cast("int").alias(f"is_{k}") for k in KINDS),
    )
    return out.fillna(0, INPUTS)


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=INPUTS, outputCol="features").transform(rows)


def evidence() -> Column:
    """1 or 0 where something besides the loose pattern tells what a loose candidate is, else null.

    Emails: a known ending, and a spelled-out or bracketed sign or a name that is no plain word.  IP: eight groups, not
    all of two digits.  Cards: the check sum.  Phones: a national layout, neither years nor a date.  What is plain but
    follows a word that announces its kind stays without a label.
    """
    value = F.col("value")
    digits = F.regexp_replace("value", "[^0-9]", "")
    ending = value.rlike(rf"(?i)[^a-z](?:{ENDINGS})[\])]?$")
    spelled = value.rlike(r"(?i)[\[(] ?at ?[\])]| dot |[\[(] ?dot ?[\])]")
    marked = value.rlike(r"(?i)^[a-z]*[0-9._%+-][a-z0-9._%+-]* at ")
    dated = (F.size(F.regexp_extract_all(value, F.lit(YEAR), F.lit(0))) >= 2) | value.rlike(
        r"(?<![0-9])(?:[0-9]{1,2}[.-][0-9]{1,2}[.-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2})(?![0-9])"
    )
    layout = value.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}$") | (
        value.rlike(r"^\(?0[1-9][0-9]{0,2}\)?[ .-]") & F.length(digits).between(9, 12)
    )
    told = {k: F.col("before").rlike(HINTS[k]) for k in ("email", "phone")}
    return (
        F.when(F.col("kind") == "email", F.when(~ending, 0).when(spelled | marked, 1).when(~told["email"], 0))
        .when(F.col("kind") == "ip", (value.rlike("^([^:]+:){7}[^:]+$") & ~value.rlike("^([^:]{2}:){7}[^:]{2}$")).cast("int"))
        .when(F.col("kind") == "card", luhn(digits).cast("int"))
        .otherwise(F.when(dated, 0).when(layout, 1).when(~told["phone"], 0))
    )


def labelled(rows: DataFrame) -> DataFrame:
    """All distinct labelled candidates; of a value that comes in several contexts the least one counts."""
    label = F.when(~F.col("loose"), F.col("base").cast("int")).otherwise(evidence())
    known = rows.withColumn("label", label.cast("double")).where("label is not null")
    return known.groupBy("kind", "loose", "value").agg(F.min(F.struct("before", "after", "label")).alias("m")).select(
        "kind", "loose", "value", "m.*", F.xxhash64("kind", "value").alias("h")
    )


def added_up(rows: DataFrame) -> DataFrame:
    """One row per features, label and part (calibrating or not), with the number of candidates and their weight.

    Every candidate counts; those of a stratum with more than ``STRATUM`` weigh less each, so no stratum drowns another.
    """
    strata = ["kind", "loose", "label"]
    part = (F.col("loose") & (F.pmod("h", F.lit(5)) == 0)).alias("calibrating")
    alike = stored(measured(rows).groupBy(*strata, part, *INPUTS).agg(F.count("*").alias("n")), "pii-learned")
    sizes = alike.groupBy(*strata).agg(F.sum("n").alias("of"))  # at most 16 rows
    weight = F.col("n") * F.least(F.lit(1.0), STRATUM / F.col("of"))
    return assembled(alike.join(F.broadcast(sizes), strata).withColumn("weight", weight))


def learned(rows: DataFrame):
    """Trees and a threshold per kind, from all distinct candidates labelled by independent evidence.

    Base matches are labelled by the base rules' own checks, loose ones by ``evidence``; ``EXAMPLES`` are added, so
    every kind has both labels.  One fifth of the loose ones calibrates, each kind by itself, the others are learned from:
    the lowest score at which the share of positives above it is ``PRECISION`` (1 if there is none), averaged with
    ``PRIOR_LIMIT``, which counts as ``PRIOR_WEIGHT`` candidates.
    """
    fixed = rows.sparkSession.createDataFrame(EXAMPLES, "kind string, value string, before string, label int").select(
        "kind", F.lit(True).alias("loose"), "value", "before", F.lit(" ").alias("after"), F.col("label").cast("double").alias("label"),
        F.lit(1).cast("long").alias("h"),
    )
    alike = added_up(labelled(rows).unionByName(fixed))
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=12, maxDepth=3, stepSize=0.3, seed=7)
    model = trees.fit(alike.where("not calibrating"))
    scored = model.transform(alike.where("calibrating")).withColumn("p", vector_to_array("probability")[1])
    by_score = scored.groupBy("kind", "p").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("positives"))
    above = Window.partitionBy("kind").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    share = by_score.select("kind", "p", "n", (F.sum("positives").over(above) / F.sum("n").over(above)).alias("share"))
    rule = share.groupBy("kind").agg(
        F.sum("n"), F.coalesce(F.min(F.when(F.col("share") >= PRECISION, F.col("p"))), F.lit(1.0))
    )
    limits = dict.fromkeys(KINDS, PRIOR_LIMIT)
    for kind, n, limit in rule.collect():  # at most one row per kind
        limits[kind] = (n * limit + PRIOR_WEIGHT * PRIOR_LIMIT) / (n + PRIOR_WEIGHT)
    return model, limits


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: rid, key, digest (md5 of the text) and ``found``: structs (place, kind, start, stop, base).

    ``start`` and ``stop`` count code points, ``stop`` is exclusive, ``place`` is the kind's place in
    ``KINDS``.  Base spans are all there; spans the trees added overlap no other span.  A null or empty text
    has none; rows may repeat and keys may be null; an empty table gives no rows; other columns are ignored.
    """
    all_rows = candidates(docs, key, text)
    rows = stored(all_rows.withColumn("base", F.when(F.col("kind").isNotNull(), ~F.col("loose") & sound())), "pii-spans")
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    shape = ["rid", "key", "digest", "kind", "start", "stop", "base"]
    kept = rows.where("base").select(*shape)
    if not rows.where("loose").isEmpty():
        model, limits = learned(rows.where("kind is not null"))
        limit = F.element_at(F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]), F.col("kind"))
        scored = model.transform(assembled(measured(rows.where("loose")))).withColumn("p", vector_to_array("probability")[1])
        extra = scored.where(F.col("p") >= limit).select(*shape)
        taken = kept.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("taken"))
        clash = F.exists(
            F.coalesce("taken", F.array().cast("array<struct<start:long,stop:long>>")),
            lambda s: (s["start"] < F.col("stop")) & (F.col("start") < s["stop"]),
        )
        before = Window.partitionBy("rid").orderBy("start", "stop", "kind").rowsBetween(Window.unboundedPreceding, -1)
        free = extra.join(taken, "rid", "left").where(~clash).select(*shape, F.max("stop").over(before).alias("reach"))
        kept = kept.unionByName(free.where("reach is null or reach <= start").select(*shape))
    whole = rows.select("rid", "key", "digest").distinct()
    per_doc = kept.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct(place.alias("place"), "start", "stop", "kind", "base"))).alias("found")
    )
    none = F.array().cast(per_doc.schema["found"].dataType)
    return whole.join(per_doc, "rid", "left").withColumn("found", F.coalesce("found", none))


def listed(found: Column) -> Column:
    one = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(one, ",")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows with every span replaced by its kind in brackets; overlapping spans become one.

    A null text stays null.  Spans depend on the text alone, so rows meet them by the text's digest.
    """
    by_text = (
        spans(docs, key, text).where(F.size("found") > 0).groupBy(F.col("digest").alias("__digest"))
        .agg(F.first("found").alias("__found"))
    )
    joined = docs.withColumn("__digest", F.md5(F.coalesce(F.col(text), F.lit("")))).join(by_text, "__digest", "left")
    order = F.sort_array(F.transform("__found", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] >= acc["at"], F.struct(
            s["stop"].alias("at"), F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")
        )).otherwise(F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out")))

    clean = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substring(
        F.col(text), (acc["at"] + 1).cast("int"), F.length(F.col(text)))))
    return joined.withColumn(text, F.when(F.col("__found").isNull(), F.col(text)).otherwise(clean)).select(*docs.columns)


def counted(base: Column, kind: str) -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op5_pii(spark, sf_dir):
    found = spans(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    return found.select(
        F.col("key").alias("doc_id"), *(counted(base, k) for k in KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )


QUERIES = {"op5_pii": op5_pii}
