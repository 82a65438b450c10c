"""URL filter: a tree of path templates per host, judged by smoothed labelled purity.

A path's segments become shapes (runs of digits and long hex ids are variable). Level by level, a
tree node's children become one wildcard if few of their pages are labelled or if their share of bad
pages does not differ statistically from that of their siblings. Of the others, those of which no
two shares differ become one branch, called by the list of their names. Nodes are divided as long as
they have labelled pages and paths that part. What remains are the host's templates. A template is
rejected where the smoothed share of bad pages is too high; the smoothing leans on the host, and
the host's share leans on all pages.
"""

import string
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import saved
from larder.session import scratch_dir

MAX_NAMES = 32       # a branch of more children is called by its first and last
LEAST_LABELLED = 5   # a child with fewer labelled pages has no share of its own
SIMILAR_Z = 2.58     # shares closer than this many standard errors are the same
SMOOTHING = 20.0     # labelled pages that the prior counts for
REJECT_FROM = 0.5    # smoothed share of bad pages


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url; both empty without '://' or a url."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the (verdict, 'host/path') rules that fits, and its verdict; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def shapes(path: Column) -> Column:
    """The path's segments with variable parts generalised."""
    hexed = F.regexp_replace(path, r"\b(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F-]{16,}\b", "{x}")
    return F.split(F.regexp_replace(hexed, r"[0-9]+", "{n}"), "/")


def differs(bad, lab, bad_0, lab_0):
    """Are two shares of bad pages apart by SIMILAR_Z standard errors? Numbers or columns; no count is 0."""
    # one bad and one good page more keep the error from being 0
    share = (bad + bad_0 + 1) / (lab + lab_0 + 2)
    gap = bad / lab - bad_0 / lab_0
    return gap * gap >= SIMILAR_Z ** 2 * share * (1 - share) * (1 / lab + 1 / lab_0)


def numbered(counts: list[tuple[int, int]]) -> list[int]:
    """Branch of each (labelled, bad), in the order of shares: none differs from a member of its branch."""
    out, branch, members = [], 0, []
    for lab, bad in counts:
        if any(differs(bad, lab, b, n) for n, b in members):
            branch, members = branch + 1, []
        # a member of a greater share and no more labelled pages never differs sooner
        if not members or lab > members[-1][0]:
            members.append((lab, bad))
        out.append(branch)
    return out


def branches(counts: DataFrame) -> DataFrame:
    """host, template, lab, bad, n, first, last -> label of the n children of these counts, or their branch.

    A branch of a few children has no label yet, it is called by their names. Children of equal counts
    are one row, so nodes are short.
    """
    schema = counts.select("host", "template", "lab", "bad").withColumns(
        {"label": F.lit(None).cast("string"), "branch": F.lit(None).cast("int")}).schema

    def run(node: pa.Table) -> pa.Table:
        lab, bad, n, first, last = (node.column(c).to_pylist() for c in ("lab", "bad", "n", "first", "last"))
        k, all_lab, all_bad = sum(n), sum(map(int.__mul__, lab, n)), sum(map(int.__mul__, bad, n))
        # only children with a share of their own, that of their siblings being another, keep their name
        own = sorted((i for i in range(len(n)) if lab[i] >= LEAST_LABELLED and all_lab > lab[i] and differs(
            bad[i], lab[i], all_bad - bad[i], all_lab - lab[i])), key=lambda i: (bad[i] / lab[i], lab[i]))
        label, branch = [first[0] if k == 1 else "*"] * len(n), [None] * len(n)
        found = numbered([(lab[i], bad[i]) for i in own])
        for _, run in groupby(zip(found, own), key=itemgetter(0)):
            at, same = zip(*run)
            size, least, greatest = sum(n[i] for i in same), min(first[i] for i in same), max(last[i] for i in same)
            for i in same:
                if size == 1:
                    label[i] = least
                elif size > MAX_NAMES:
                    label[i] = f"({least}|...{size - 2}...|{greatest})"
                else:
                    label[i], branch[i] = None, at[0]
        return node.select(["host", "template", "lab", "bad"]).append_column(
            "label", pa.array(label, pa.string())).append_column("branch", pa.array(branch, pa.int32()))

    return counts.groupBy("host", "template").applyInArrow(run, schema)


def labels(children: DataFrame) -> DataFrame:
    """host, template, child -> label, from the children's n_labelled and n_bad."""
    node = ["host", "template"]
    known = children.join(branches(children.groupBy(*node, "lab", "bad").agg(
        F.count(F.lit(1)).alias("n"), F.min("child").alias("first"), F.max("child").alias("last"))), [*node, "lab", "bad"])
    # a child is in one branch, so the first name tells branches of a node apart
    lists = known.where("branch IS NOT NULL").groupBy(*node, "branch").agg(F.concat(
        F.lit("("), F.array_join(F.sort_array(F.collect_list("child")), "|"), F.lit(")")).alias("names"))
    return known.join(lists, [*node, "branch"], "left").select(
        *node, "child", F.coalesce("label", "names").alias("label"))


def templates(leaves: DataFrame) -> DataFrame:
    """host, shape -> template, from leaves (host, shape array, n_labelled, n_bad), one per shape.

    A round takes each node to the next level where its paths part. A node without labelled pages
    has its host's share however it is divided, so it is closed. The rounds work on totals per
    shape; a host with most pages is a few rows here.
    """
    spark, folder, rounds = leaves.sparkSession, scratch_dir(leaves.sparkSession, "templates"), 0
    at = leaves.withColumns({"template": F.array().cast("array<string>"), "rest": F.col("shape")})
    schema = at.schema
    while rounds == 0 or not at.isEmpty():
        # what the least and the greatest have in common, all have
        nodes = at.groupBy("host", "template").agg(
            (F.sum("n_labelled") == 0).alias("closed"), F.min("rest").alias("lo"), F.max("rest").alias("hi"))
        parted = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), F.lit(False))
        nodes = nodes.select("host", "template", "closed", F.when(parted > 0, parted - 1).otherwise(
            F.size("lo")).cast("int").alias("common"), (parted > 0).alias("parted"))
        at = at.join(nodes, ["host", "template"])
        tail = F.when(F.col("closed") & F.col("parted"), F.array(F.lit("**"))).otherwise(F.array().cast("array<string>"))
        at = at.withColumns({
            "template": F.concat("template", F.slice("rest", F.lit(1), F.col("common")), tail),
            "rest": F.when(~F.col("closed") & (F.size("rest") > F.col("common")), F.slice(
                "rest", F.col("common") + 1, F.size("rest")))}).drop("closed", "common", "parted")
        # written here and at the round's end, so plans stay small: the driver holds several versions of each
        at = saved(at.withColumn("child", F.col("rest")[0]), "parted")
        named = labels(at.where("child IS NOT NULL").groupBy("host", "template", "child").agg(
            F.sum("n_labelled").alias("lab"), F.sum("n_bad").alias("bad")))
        at = at.join(named, ["host", "template", "child"], "left").withColumns({
            "template": F.when(F.col("label").isNull(), F.col("template")).otherwise(F.concat("template", F.array("label"))),
            "rest": F.slice("rest", F.lit(2), F.size("rest"))})
        at.select(*schema.names).write.parquet(f"{folder}/{rounds}")
        at = spark.read.schema(schema).parquet(f"{folder}/{rounds}").where("rest IS NOT NULL")
        rounds += 1
    done = spark.read.schema(schema).parquet(*[f"{folder}/{r}" for r in range(rounds)]).where("rest IS NULL")
    return done.withColumn("template", F.array_join("template", "/")).drop("rest")


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad_share of every page.

    `labelled` has page_id and bad (boolean); a page with several labels counts once for each, null
    labels count for none. A null url or one without '://' has an empty host and path, which is a
    template as any other. A host without labelled pages is judged by the share over all pages,
    without any labels everything is allowed. Repeated rows come back repeated, other columns are
    not read, an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("shape", shapes(F.col("path")))
    marks = labelled.where("bad IS NOT NULL").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_labelled"), F.sum(F.col("bad").cast("bigint")).alias("n_bad"))
    leaves = saved(rows.join(marks, "page_id", "left").groupBy("host", "shape").agg(
        F.coalesce(F.sum("n_labelled"), F.lit(0)).alias("n_labelled"),
        F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n_bad")), "leaves")
    total = leaves.agg(F.sum("n_labelled").alias("lab"), F.sum("n_bad").alias("bad")).first()
    overall = (total.bad or 0) / total.lab if total.lab else 0.0

    def smoothed(bad, lab, prior):
        return (bad + SMOOTHING * prior) / (lab + SMOOTHING)

    at = templates(leaves)
    hosts = at.groupBy("host").agg(smoothed(
        F.sum("n_bad"), F.sum("n_labelled"), F.lit(overall)).alias("host_share"))
    judged = at.groupBy("host", "template").agg(
        F.sum("n_bad").alias("bad"), F.sum("n_labelled").alias("lab")).join(hosts, "host").select(
        "host", "template", smoothed(F.col("bad"), F.col("lab"), F.col("host_share")).alias("bad_share"))
    known = saved(at.select("host", "shape", "template").join(judged, ["host", "template"]), "judged")
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    return rows.join(known, ["host", "shape"], "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(says, F.when(F.col("bad_share") >= REJECT_FROM, "block").otherwise("allow"))
        .alias("verdict"), "template", "bad_share")
