"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a file is addressed by the SHA-256 of its content. The ledger holds
which (blob, rule, rule version) have been scanned and what was found. A scan takes the
pairs that the ledger lacks, runs those rules over one copy of each such blob, and joins
the findings of all blobs back to every path that has them.

Spans are in code points, end exclusive, leftmost and non-overlapping per rule. Null
texts count as empty. Repeated rows and copies give the findings of their blob each.
Columns other than those named are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrid.llm.tables import may_be_in, unused, written


@dataclass(frozen=True)
class Rule:
    """kind, version, pattern, and the group of it that must have `least` characters.

    `sieve` finds every text with such a match at less cost."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    sieve: str = ""


_ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]%s)"""
#: fixed values: the rules of the contract, in the order in which kinds are listed. A run
#: of one class matches whole, so its least length can stand in the pattern; a short
#: assignment takes its place and is dropped afterwards.
BASE_RULES = (
    Rule("assign", 1, _ASSIGN % "+", 2, 12, _ASSIGN % "{12,}"),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
_PEM = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_BREAK = r"(?:[\x20\t]*+(?:\r\n|\r|\n|(?:\\+r)?\\+n)[\x20\t>|#*]*+)"
#: a rule of this library's own: private keys up to the END line before the next heading. Where that
#: is missing, the heading, its fields and the base64 after it: runs of 16 characters, then also shorter lines.
#: Line breaks may be escaped. Quantifiers that keep what they have need no stack.
MORE_RULES = (
    Rule(
        "pem",
        2,
        _PEM
        + r"(?:(?:(?!-----BEGIN\x20)[\s\S])*?-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
        + rf"|(?:{_BREAK}++(?:Proc-Type|DEK-Info|Version|Comment):[^\r\n\\]*+)*+"
        + rf"(?:(?:{_BREAK}++|[\x20\t]*+)[A-Za-z0-9+/=]{{16,}}+"
        + rf"(?:(?:{_BREAK}++|[\x20\t]++)[A-Za-z0-9+/=]{{16,}}+|{_BREAK}++[A-Za-z0-9+/=]++(?=[\x20\t]*+(?:[\r\n\\\"'`,;<)\]}}]|(?![\s\S]))))*+)?+)",
        sieve=_PEM,
    ),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "struct<kind_at:int,kind:string,start:int,end:int>"
LEDGER = ["blob", "kind", "version", "spans"]


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def matches(text: Column, rule: Rule, at: int) -> Column:
    """Spans of one rule: the texts between matches and the matches themselves give the places.

    The n-th match starts after n+1 pieces between matches and n matches."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(whole)), whole, lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("size")))
    steps = F.zip_with(steps, value, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), F.length(v).alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS array<{SPAN}>)").alias("spans"))

    def add(acc, s):
        begin, end = acc["at"] + s["gap"], acc["at"] + s["gap"] + s["size"]
        span = F.struct(F.lit(at).alias("kind_at"), F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end"))
        kept = F.when(s["value"] >= rule.least, F.array(span)).otherwise(F.expr(f"CAST(array() AS array<{SPAN}>)"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], kept).alias("spans"))

    return F.aggregate(steps, start, add, lambda acc: acc["spans"])


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, kind, version, spans of each rule over the text of each blob."""
    places = {r: i for i, r in enumerate(RULES)}
    none = F.expr(f"CAST(array() AS array<{SPAN}>)")
    found = F.array(
        *(
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.when(F.col("text").rlike(r.sieve or r.pattern), matches(F.col("text"), r, places.get(r, len(RULES) + i))).otherwise(none).alias("spans"),
            )
            for i, r in enumerate(rules)
        )
    )
    return blobs.select("blob", F.inline(found))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Findings per path, and the new rows of the ledger.

    Findings: path, blob, and `spans` of all rules by start and kind. New ledger rows:
    blob, kind, version, spans; append them to the ledger for the next scan.
    """
    source = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paths = written(source.select("path", content_address(F.col("text")).alias("blob")), "paths")
    # one path stands for each blob; ids and digests travel here, not texts
    first = paths.groupBy("blob").agg(F.min("path").alias("path"))
    todo = first if ledger is None else first.join(_done(ledger, rules), "blob", "left").where(F.coalesce(F.size("done"), F.lit(0)) < len(rules))
    source = source.withColumn("blob", content_address(F.col("text")))
    # one copy of each blob, by its path; a path may be null
    unseen = source.alias("s").join(todo.alias("t"), (F.col("s.blob") == F.col("t.blob")) & F.col("s.path").eqNullSafe(F.col("t.path"))).select("s.*")
    new = scan_blobs(unseen, rules)
    if ledger is not None:
        seen = ledger.where(_of(rules)).select("blob", "kind", "version")
        new = new.join(seen, ["blob", "kind", "version"], "left_anti")
    new = written(new.dropDuplicates(["blob", "kind", "version"]).select(*LEDGER), "ledger")
    found = by_blob(new if ledger is None else ledger.select(*LEDGER).unionByName(new), rules)
    none = F.expr(f"CAST(array() AS array<{SPAN}>)")
    out = paths.join(found, "blob", "left")
    return out.select(F.col("path").alias(path), "blob", F.coalesce("spans", none).alias("spans")), new


def by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its spans by start and kind, for blobs with findings. They are as many as a text holds, so they fit one row."""
    found = ledger.where(_of(rules) & (F.size("spans") > 0)).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return written(found.select("blob", F.array_sort("spans", _by_start).alias("spans")), "findings")


def mask(docs: DataFrame, path: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """docs with each secret replaced by a mark; its number of characters follows, if there is a column for it."""
    _, ledger = scan(docs, path=path, text=text)
    blob, spans = unused(docs, "__blob"), unused(docs, "__spans")
    found = by_blob(ledger).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    named = docs.withColumn(blob, content_address(F.col(text)))
    maybe = may_be_in(found, blob)  # the other texts have no finding and are not shuffled
    joined = named.where(maybe).join(found, blob, "left")
    clean = F.when(F.col(spans).isNull(), F.col(text)).otherwise(masked(F.col(text), F.col(spans)))
    changed = joined.withColumn(text, clean)
    if n_chars in docs.columns:
        changed = changed.withColumn(n_chars, F.when(F.col(spans).isNull(), F.col(n_chars)).otherwise(F.length(text)).cast(docs.schema[n_chars].dataType))
    return named.where(~maybe).select(*docs.columns).unionByName(changed.select(*docs.columns))


def _of(rules: tuple[Rule, ...]) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    return out


def _done(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    return ledger.where(_of(rules)).groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("done"))


def _by_start(a: Column, b: Column) -> Column:
    key = lambda x: F.struct(x["start"], x["kind_at"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each maximal run of spans replaced by a mark. Spans are sorted by start."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, add)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
