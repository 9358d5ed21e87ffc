"""Operator 3: repeated lines by a log-template tree, in DataFrame functions only.

A line's tokens with digits in them are variable fields. The tree has a fixed
depth: token count, then the leading tokens; that is a leaf. Within a leaf the
commonest token of every position makes a pattern, and lines that agree with it
at most positions are one template, whatever stands at the others. Further leaves
take two of a line's leading, middle and trailing tokens: there the commonest line
(of ties, the greatest) is the pattern. So several templates that share a leaf are told apart, and one
whose leading tokens vary is found, by what else they share. Any other line is a
template of its own. A template that recurs in enough documents is dropped from
all but the first of them. So is a passage that runs over several lines: lines that
stand side by side in several documents, and together are as long as a long one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise


@dataclass(frozen=True)
class Settings:
    """A template of ``long`` tokens or more is dropped if it is in ``docs_long``
    documents, a shorter one if in ``docs_short``; templates of a leaf are merged
    where ``alike`` of the positions agree, from ``merged_from`` tokens on; ``depth``
    tokens are leading, middle or trailing."""

    depth: int = 3
    long: int = 50
    docs_long: int = 2
    docs_short: int = 5
    alike: float = 0.8
    merged_from: int = 5
    field: str = "<*>"


def _lines(docs: DataFrame, s: Settings) -> DataFrame:
    """(i, h, n, leaf, own, tokens, masked, middle, last) of each line that isn't
    blank; ``leaf`` and ``own`` together are 128 bits of hash of the masked line."""
    rows = docs.select(F.col("doc_id").cast("long").alias("i"), F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    line = rows.withColumn("line", F.trim("line")).where("line <> ''")
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", r"[^\s0-9]*+[0-9]\S*", s.field)).otherwise(F.col("line"))
    line = line.select("i", "h", "n", masked.alias("masked"))
    tokens = F.length("masked") - F.length(F.replace(F.col("masked"), F.lit(" "), F.lit(""))) + 1
    leaf = F.xxhash64(tokens, F.substring_index("masked", " ", s.depth))
    line = line.select("i", "h", "n", leaf.alias("leaf"), F.xxhash64("masked").alias("own"), tokens.alias("tokens"), "masked")
    upto = f"substring_index(masked, ' ', CAST(floor(tokens / 2) AS INT) + {s.depth - 1})"
    middle, last = (F.expr(f"xxhash64(substring_index({x}, ' ', -{s.depth}))") for x in (upto, "masked"))
    return line.withColumns({"middle": middle, "last": last})


def _enough(s: Settings):
    """In how many documents a template must be, by its tokens."""
    return F.when(F.col("tokens") >= s.long, s.docs_long).otherwise(s.docs_short)


#: Lines are first looked for by this many residues of their hashes: tables of a
#: fixed greatest size, which are broadcast so that other lines aren't shuffled.
RESIDUES = 1 << 20


def _low(c: str):
    # by bits and without a filter, so that no null check computes a line's hash again
    return F.col(c).bitwiseAND(RESIDUES - 1)


def _open(lines: DataFrame, group: str, s: Settings) -> DataFrame:
    """Groups of several lines in which a template could recur often enough."""
    sums = lines.groupBy(group, "tokens").agg(F.count("*").alias("several"), F.sum("n").alias("total"))
    return sums.where((F.col("several") > 1) & (F.col("total") >= _enough(s))).select(group)


def generalised(docs: DataFrame, templates: DataFrame, s: Settings) -> DataFrame:
    """(leaf, own, form, part) of the lines that patterns cover: ``form`` and
    ``part`` name a pattern; of leaves in which a template could recur often enough."""
    merged = templates.where(F.col("tokens") >= s.merged_from)
    leaves = materialise(_open(merged, "leaf", s), "leaves")
    pairs = F.array(F.xxhash64("leaf", "last"), F.xxhash64("leaf", "middle", F.lit(1)), F.xxhash64("tokens", "middle", "last", F.lit(2)))
    keyed = merged.select("leaf", "own", "tokens", "n", F.explode(pairs).alias("form"))
    twice = materialise(keyed.join(_open(keyed, "form", s), "form"), "pair-lines")
    # the words themselves, of these lines only
    by_leaf = leaves.select(_low("leaf").alias("residue")).distinct().withColumn("in_leaf", F.lit(True))
    by_own = twice.select(_low("own").alias("rest")).distinct().withColumn("in_pair", F.lit(True))
    lines = _lines(docs, s).select("leaf", "own", "tokens", "masked", _low("leaf").alias("residue"), _low("own").alias("rest"))
    lines = lines.join(F.broadcast(by_leaf), "residue", "left").join(F.broadcast(by_own), "rest", "left").where("in_leaf OR in_pair")
    texts = materialise(lines.groupBy("leaf", "own", "tokens").agg(F.first("masked").alias("masked")), "leaf-lines")
    token = texts.join(leaves, "leaf", "left_semi").select("leaf", "own", "tokens", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    counted = token.groupBy("leaf", "at", "token").count()
    modal = counted.groupBy("leaf", "at").agg(F.max(F.struct("count", "token"))["token"].alias("modal"))
    agree = token.join(modal, ["leaf", "at"]).groupBy("leaf", "own", "tokens").agg(F.count_if(F.col("token") == F.col("modal")).alias("same"))
    covered = materialise(agree.where(F.col("same") >= s.alike * F.col("tokens")).select("leaf", "own"), "covered")
    # pairs of parts: the commonest line is the pattern
    held = twice.join(texts.select("leaf", "own", "masked"), ["leaf", "own"])
    pattern = held.groupBy("form").agg(F.max(F.struct("n", "masked"))["masked"].alias("pattern"))
    member = held.join(pattern, "form")
    words = lambda c: F.split(c, " ")
    same = F.size(F.filter(F.zip_with(words("masked"), words("pattern"), lambda x, y: x == y), lambda x: x))
    member = member.where(same >= s.alike * F.col("tokens")).select("form", "leaf", "own", "tokens", "n")
    member = materialise(member.join(covered.withColumn("in_leaf", F.lit(True)), ["leaf", "own"], "left"), "members")
    # a pattern all of whose lines one leaf's pattern covers says nothing new
    about = member.groupBy("form", "tokens").agg(F.count("*").alias("several"), F.sum("n").alias("total"), F.count("in_leaf").alias("held"), F.min("leaf").alias("low"), F.max("leaf").alias("high"))
    new = about.where((F.col("several") > 1) & (F.col("total") >= _enough(s)) & ((F.col("held") < F.col("several")) | (F.col("low") != F.col("high")))).select("form")
    further = member.join(new, "form", "left_semi").select("leaf", "own", "form", F.lit(1).cast("long").alias("part"))
    return covered.select("leaf", "own", F.col("leaf").alias("form"), F.lit(0).cast("long").alias("part")).union(further)


def runs(lines: DataFrame, templates: DataFrame, s: Settings) -> DataFrame:
    """(i, h, n) of the lines of passages that run over lines.

    Two lines, one right after the other, that are so in ``docs_long`` documents are a
    recurring pair; of adjacent pairs that recur from an earlier document, those of
    ``long`` tokens or more together are such a passage. Every pair stays in its first
    document.
    """
    again = lines.join(templates.where("n > 1").select("leaf", "own"), ["leaf", "own"], "left_semi")
    again = again.select("i", "h", "n", "leaf", "own", "tokens").dropDuplicates(["i", "h", "n"])
    inside = Window.partitionBy("i", "h").orderBy("n")
    after = lambda c: F.lead(c).over(inside)
    pair = again.select("i", "h", "n", "tokens", after("n").alias("to"), after("tokens").alias("more"), F.xxhash64("leaf", "own", after("leaf"), after("own")).alias("x"), F.xxhash64("own", after("own"), F.lit(3)).alias("y"))
    pair = materialise(pair.where("to = n + 1").drop("to"), "line-pairs")
    # a pair said twice in one document counts once
    often = pair.select("x", "y", "i", "h").distinct().groupBy("x", "y").agg(F.count("*").alias("docs"), F.min("i").alias("first"))
    often = often.where(F.col("docs") >= s.docs_long).select("x", "y", "first")
    later = pair.join(often, ["x", "y"]).where(~F.col("i").eqNullSafe(F.col("first")))
    run = later.withColumn("run", F.col("n") - F.row_number().over(inside)).groupBy("i", "h", "run")
    run = run.agg(F.min("n").alias("low"), F.max("n").alias("high"), (F.sum("tokens") + F.max_by("more", "n")).alias("whole"))
    return run.where(F.col("whole") >= s.long).select("i", "h", F.explode(F.sequence(F.col("low"), F.col("high") + 1)).alias("n"))


def lines_to_drop(docs: DataFrame, s: Settings) -> DataFrame:
    """(i, h, drop): for each document that has any, the numbers of its lines to
    drop. ``h`` tells rows of one id apart."""
    lines = materialise(_lines(docs, s).drop("masked"), "lines")
    templates = lines.groupBy("leaf", "own", "tokens").agg(F.count("*").alias("n"), F.min("middle").alias("middle"), F.min("last").alias("last"))
    templates = materialise(templates, "templates")
    general = materialise(generalised(docs, templates, s), "generalised")
    # most lines are alone: only templates that may be dropped go on
    alone = templates.where(F.col("n") >= _enough(s)).join(general.where("part = 0"), ["leaf", "own"], "left_anti")
    asked = materialise(general.union(alone.select("leaf", "own", F.col("leaf").alias("form"), F.col("own").alias("part"))), "asked-templates")
    named = materialise(lines.join(asked, ["leaf", "own"]).select("form", "part", "tokens", "i", "h", F.col("n").alias("n")), "named-lines")
    # one row for a document and template, then summed before the shuffle
    once = named.select("form", "part", "tokens", "i", "h").distinct()
    often = once.groupBy("form", "part", "tokens").agg(F.count("*").alias("docs"), F.min("i").alias("first")).where(F.col("docs") >= _enough(s))
    often = materialise(often.select("form", "part", "first"), "recurring")
    drop = named.join(often, ["form", "part"]).where(~F.col("i").eqNullSafe(F.col("first"))).select("i", "h", "n")
    drop = drop.union(runs(lines, templates, s))
    return materialise(drop.groupBy("i", "h").agg(F.collect_set("n").alias("drop")), "dropped-lines")


def drop_lines(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, ``_lines`` and
    ``_dropped`` (counts).

    The document of the least id keeps a template's lines; other columns pass
    through, but for columns of these two names, which are taken over. A null text
    is left out (it has no line), an empty one stays; blank lines are never dropped;
    rows of a null id are treated as later ones; rows that repeat an id and a text
    are one document; lines repeated inside one document count once and go or stay
    together. An empty table gives no rows.
    """
    s = settings or Settings()
    docs = docs.drop("_lines", "_dropped").where("text IS NOT NULL")
    found = lines_to_drop(docs, s).select(F.col("i").alias("_i"), F.col("h").alias("_h"), F.col("drop").alias("_drop"))
    both = docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_i"]) & (F.xxhash64(docs["text"]) == found["_h"]), "left")
    parts, drop = F.split(docs["text"], "\n"), found["_drop"]
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), drop)
    kept = F.when(drop.isNull(), docs["text"]).otherwise(F.array_join(F.transform(left, lambda k: F.get(parts, k)), "\n"))
    names = [docs[f"`{c}`"] if c != "text" else kept.alias("text") for c in docs.columns]
    return both.select(*names, F.size(parts).alias("_lines"), F.when(drop.isNull(), 0).otherwise(F.size(drop)).alias("_dropped"))
