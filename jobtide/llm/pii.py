"""Personal data: checked patterns, and more found by bootstrapping over the words around them.

Everything here is a DataFrame or SQL expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import kept
from .frames import numbered, restored

KINDS = ["email", "ip", "card", "phone"]
#: The stated patterns, without backtracking: a match starts where its first run starts, or right after another match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PARTS = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$".replace("0*+", "0*")
#: Candidates: tokens with a digit, an at sign in one of its forms or hex groups, and runs of digit groups with blanks.
MARK = r"[0-9@]|[(\[](?i:at)[)\]]|:[0-9A-Fa-f]{0,4}:"
TOKEN = rf"(?<!\S)(?:(?!{MARK})\S)*+(?:{MARK})\S*+"
GROUPS = r"(?<![\p{L}\p{N}+@._:/()-])[+(]?[0-9](?:[\x20().-]{0,2}[0-9])++(?![\p{L}\p{N}@])"
SPACED = r"[0-9][().-]?\x20[\x20().-]?[0-9]|[0-9][)]?\x20[\x20(]?[0-9]"
#: What an unseen identifier of each kind must look like; the lengths are those that addresses may have.
SHAPES = [r"^[^@\s]{1,64}(?:@|\(at\)|\[at\])[^@\s]{1,255}$", r"^(?:[0-9]+[.:_-]){3}[0-9]+$|^[0-9a-f]{0,4}(?::[0-9a-f]{0,4}){3,7}$",
          r"^(?:[0-9][ -]?){12,19}$", r"^[+(]?(?:[0-9][ ().-]{0,2}){6,14}[0-9]$"]
ROUNDS, SUPPORT, CONFIDENCE, BELIEF = 3, 3, 0.8, 0.9
CONTEXT = 48


def _spans(text: Column, pattern: str) -> Column:
    """Start, end and text of each match, from the lengths of the matches and of what lies between them."""
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, hit: F.struct(F.length(gap).alias("g"), hit.alias("t")))
    empty = F.expr("cast(array() as array<struct<s:int,e:int,t:string>>)")
    return F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["g"] + F.coalesce(F.length(p["t"]), F.lit(0))).alias("at"),
            F.when(p["t"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + p["g"]).alias("s"), (acc["at"] + p["g"] + F.length(p["t"])).alias("e"), p["t"].alias("t"))))).alias("out")),
        lambda acc: acc["out"])


def _none() -> Column:
    return F.expr("cast(array() as array<struct<s:int,e:int,t:string>>)")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check sum: every second one from the right is doubled and its digits added."""
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.when((n - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, i, F.lit(1)).cast("int") + 1)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    """The checked spans of each kind."""
    digits = text.rlike("[0-9]")
    return {
        "email": F.when(text.contains("@"), _spans(text, EMAIL)).otherwise(_none()),
        "ip": F.when(text.rlike(IP), F.filter(_spans(text, IP), lambda x: x["t"].rlike(PARTS))).otherwise(_none()),
        "card": F.when(digits, F.filter(
            F.filter(_spans(text, CARD), lambda x: F.length(_digits(x["t"])).between(16, 19)),
            lambda x: _luhn(_digits(x["t"])))).otherwise(_none()),
        "phone": F.when(text.contains("+"), F.filter(_spans(text, PHONE), lambda x: F.length(_digits(x["t"])).between(8, 15))).otherwise(_none()),
    }


def _beside(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The words to the left and right of a span: lower case, letters only, null if there is none near."""
    left = F.substring(text, F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT)))
    right = F.substring(text, end + 1, F.lit(CONTEXT))
    word = lambda c, pattern: F.nullif(F.regexp_replace(F.lower(F.regexp_extract(c, pattern, 1)), r"[^\p{L}]", ""), F.lit(""))
    return word(left, r"(\S+)\s*$"), word(right, r"^\s*(\S+)")


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, base, items): the checked spans, and every identifier-like token with the words beside it.

    A document is known by its id and its text's hash, so that rows that repeat get the same answer.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", *[c.alias(k) for k, c in _base(F.col("text")).items()])

    def marked(kind: int):
        return lambda x: F.struct(F.lit(kind).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["t"].alias("t"))

    base = F.concat(*[F.transform(k, marked(i)) for i, k in enumerate(KINDS)])
    rows = rows.select("doc_id", "text", base.alias("base"))

    def item(kind: Column, t: Column, s: Column, e: Column) -> Column:
        left, right = _beside(F.col("text"), s, e)
        return F.struct(kind.alias("k"), F.lower(t).alias("inst"), s.alias("s"), e.alias("e"), left.alias("l"), right.alias("r"))

    def core(x: Column) -> Column:
        head = F.regexp_replace(x["t"], r"^[^\p{L}\p{N}+(]+", "")
        body = F.regexp_replace(head, r"[^\p{L}\p{N}]+$", "")
        start = x["s"] + F.length(x["t"]) - F.length(head)
        return F.struct(start.alias("s"), (start + F.length(body)).alias("e"), body.alias("t"))

    tokens = F.when(F.col("text").rlike(MARK), _spans(F.col("text"), TOKEN)).otherwise(_none())
    free = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))
    fits = lambda x: F.lower(x["t"]).rlike("|".join(SHAPES))
    runs = F.when(F.col("text").rlike(SPACED), F.filter(_spans(F.col("text"), GROUPS), lambda x: x["t"].contains(" ") & fits(x) & free(x))).otherwise(_none())
    loose = F.filter(F.transform(F.filter(tokens, free), core), lambda x: x["e"] > x["s"])
    rows = rows.select("doc_id", F.xxhash64("text").alias("hash"), "text", "base", loose.alias("loose"), runs.alias("runs"))
    # Pieces of a run that fit no kind by themselves are no candidates beside it.
    whole = F.filter("loose", lambda x: ~F.exists("runs", lambda r: (r["s"] <= x["s"]) & (r["e"] >= x["e"])) | fits(x))
    rows = rows.select("doc_id", "hash", "text", "base", F.concat(whole, "runs").alias("loose"))
    items = F.concat(F.transform("base", lambda b: item(b["k"], b["t"], b["s"], b["e"])),
                     F.transform("loose", lambda x: item(F.lit(-1), x["t"], x["s"], x["e"])))
    return rows.select("doc_id", "hash", F.transform("base", lambda b: F.struct(b["k"].alias("k"), b["s"].alias("s"), b["e"].alias("e"))).alias("base"), items.alias("items"))


def _discovered(items: DataFrame, rounds: int, support: int, confidence: float, belief: float) -> DataFrame:
    """(inst, k): identifiers outside the checked ones that trusted patterns point to.

    Instances and the patterns beside them (a word to the left, one to the right, or both) form a graph. A pattern is trusted for
    a kind if at least `support` and a share of `confidence` of its instances are believed to be of that kind; an instance of
    fitting shape is believed if its trusted patterns are not all wrong with probability of at least `belief`. Each round
    scores patterns from instances and instances from patterns, both by grouped sums over the distinct edges.
    """
    kinds = range(len(KINDS))
    beside = F.array(F.concat(F.lit("l:"), "l"), F.concat(F.lit("r:"), "r"), F.concat(F.lit("b:"), "l", F.lit(" "), "r"))
    edges = kept(items.select("inst", F.explode(beside).alias("pat")).filter("pat is not null").distinct(), "edges")
    seeds = kept(items.groupBy("inst").agg(*[F.max((F.col("k") == i).cast("double")).alias(f"s{i}") for i in kinds]), "seeds")
    fits = [F.when(F.col("inst").rlike(SHAPES[i]), 1.0).otherwise(0.0) for i in kinds]
    beliefs = seeds.select("inst", *[F.col(f"s{i}").alias(f"b{i}") for i in kinds])
    for _ in range(rounds):
        scored = edges.join(beliefs, "inst").groupBy("pat").agg(F.count("*").alias("n"), *[F.sum(f"b{i}").alias(f"b{i}") for i in kinds])
        trust = [F.when((F.col(f"b{i}") >= support) & (F.col(f"b{i}") >= confidence * F.col("n")), F.least(F.col(f"b{i}") / (F.col("n") + 0.1), F.lit(0.99))).otherwise(0.0) for i in kinds]
        trusted = scored.select("pat", *[c.alias(f"c{i}") for i, c in enumerate(trust)]).filter(" or ".join(f"c{i} > 0" for i in kinds))
        said = edges.join(trusted, "pat").groupBy("inst").agg(*[(1 - F.exp(F.sum(F.log1p(-F.col(f"c{i}"))))).alias(f"p{i}") for i in kinds])
        beliefs = seeds.join(said, "inst", "left").select("inst", *[
            F.greatest(F.col(f"s{i}"), F.when(F.coalesce(F.col(f"p{i}") * fits[i], F.lit(0.0)) >= belief, F.col(f"p{i}")).otherwise(0.0)).alias(f"b{i}") for i in kinds])
        beliefs = kept(beliefs.filter(" or ".join(f"b{i} > 0" for i in kinds)), "beliefs")
        beliefs = beliefs.join(seeds.select("inst"), "inst", "right").na.fill(0.0)
    top = F.greatest(*[F.col(f"b{i}") for i in kinds])
    best = F.coalesce(*[F.when(F.col(f"b{i}") == top, F.lit(i)) for i in kinds])
    fresh = seeds.filter(" and ".join(f"s{i} = 0" for i in kinds)).select("inst")
    return beliefs.join(fresh, "inst").filter(top > 0).select("inst", best.alias("k"))


def find(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE, belief: float = BELIEF) -> DataFrame:
    """(doc_id, hash, base, spans) of every document: arrays of (kind, start, end) in code points, end exclusive.

    `base` are the checked patterns; `spans` adds what the context patterns discover. Needs `doc_id` and `text`; other columns are ignored. A null text is
    empty; empty texts have no spans; repeated rows are reported each; a null id is an id; an empty table gives no rows.
    """
    found = kept(_found(docs), "found")
    items = found.select("doc_id", "hash", F.explode("items").alias("i")).select("doc_id", "hash", "i.*")
    more = items.filter("k < 0").select("doc_id", "hash", "inst", "s", "e").join(_discovered(items, rounds, support, confidence, belief), "inst")
    more = more.groupBy("doc_id", "hash").agg(F.collect_set(F.struct("k", "s", "e")).alias("more"))
    more = more.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "more")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return found.select("doc_id", "hash", "base").join(more, same, "left").select("doc_id", "hash", "base", spans.alias("spans"))


def _written(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"], x["e"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the checked spans, and all spans written out."""
    count = lambda i: F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


def redact(docs: DataFrame, **settings: float) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; spans that overlap become one. `n_chars` follows, if there.

    All columns and rows stay; texts without spans, and null texts, stay as they are.
    """
    columns = docs.columns
    found = find(docs, **settings).filter(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), F.col("spans").alias("_spans"))
    found = found.dropDuplicates(["_id", "_hash"])
    rows = numbered(docs, "doc_id", "text").withColumn("_text_hash", F.xxhash64("text"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left")
    ordered = F.array_sort(F.transform("_spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    built = F.aggregate(
        ordered, start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(x["s"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, x["s"] - acc["at"]), F.element_at(names, x["k"] + 1)))).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(built)
    out = restored(rows.withColumn("text", text), columns, "doc_id", "text")
    if "n_chars" in columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out
