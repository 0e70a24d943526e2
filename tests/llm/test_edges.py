"""Odd settings, names and values that earlier versions of operators got wrong."""

import random
import re

import pytest
from pyspark.sql import functions as F

from staywarehouse.llm import decontaminate, jaccard, perplexity, pii, shards, templates

from . import brute


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lines_that_agree_too_little_stay_whatever_their_hashes(spark):
    # The two odd words have the same leading 16 bits of their hashes.
    docs = [(1, "one two three four five qddjdmo seven eight"),
            (2, "one two three four five qhhigoj other words")]
    found = got(templates.cleaned(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == docs


def test_common_lines_in_a_wide_leaf(spark):
    """The tree over a leaf of many lines, one of them in every document, by brute force."""
    rng = random.Random(4)
    rows = []
    for doc in range(120):
        own = ["the very same line in all of them", f"the very same line {rng.choice('ab')} x y z"]
        own += [" ".join(["one of the few"] + [rng.choice("abcde") for _ in range(6)])]
        rows.append((doc, "\n".join(rng.sample(own, 3))))
    _, leaves = brute.templates(rows)
    owner = {}
    for leaf in leaves.values():
        begun = []
        for first, tokens, _ in sorted(leaf, key=lambda x: (x[0], x[1])):
            fits = [b for b in begun
                    if sum(x == y for x, y in zip(b[1], tokens)) >= 0.7 * len(tokens)]
            owner[tokens] = fits[0][0] if fits else first
            begun += [] if fits else [(first, tokens)]
    ties = {(first, len(t), t[:4]) for leaf in leaves.values() for first, t, _ in leaf}
    assert len(ties) > 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = dict(got(templates.report(df).select("doc_id", F.coalesce("text", F.lit("")))))
    same = tuple("the very same line in all of them".split())
    for doc, text in rows:
        for line in text.split("\n"):
            if tuple(line.split()) == same:
                assert (line in kept[doc].split("\n")) == (owner[same] == doc)


@pytest.mark.parametrize("threshold", [0.3, 0.51])
@pytest.mark.parametrize("small,block", [(48, 512), (3, 8)])
def test_more_bands_than_bits_of_a_number(spark, threshold, small, block):
    bands, _ = jaccard.banding(threshold, 0.9999)
    assert bands > 64 or threshold > 0.3
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    body, docs = [word() for _ in range(60)], []
    for i in range(80):
        own = list(body)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(60)] = word()
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = got(jaccard.join(df, threshold=threshold, recall=0.9999, small=small, block=block))
    wanted = sorted(brute.links(docs, share=threshold), key=repr)
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    off = [abs(a[2] - b[2]) for a, b in zip(found, wanted)]
    # A pair just at the threshold may be missed; none is counted twice.
    assert all(a[2] <= b[2] for a, b in zip(found, wanted)) and sum(off) <= 4


@pytest.mark.parametrize("name", ["n", "r", "p", "k", "a`b", "_run"])
def test_places_do_not_depend_on_the_name_of_the_key(spark, name):
    ids = spark.range(2000).withColumnRenamed("id", "doc_id")
    own = ids.withColumnRenamed("doc_id", name)
    nodes = shards.tree(40)
    wanted = dict(got(shards.place(ids, "doc_id", nodes).select("doc_id", "shard")))
    assert dict(got(shards.place(own, name, nodes))) == wanted and len(set(wanted.values())) == 40


def test_slots_keep_columns_of_any_name(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "id % 3 AS shard", "id AS _run", "1 AS _own",
                                     "'x' AS _before", "2 AS _n", "3 AS _first")
    out = shards.slots(df, "shard", ["doc_id"])
    assert sorted(out.columns) == sorted([*df.columns, "slot"])
    assert out.where("_run <> doc_id OR _own <> 1 OR _before <> 'x'").isEmpty()
    assert got(out.groupBy("shard").agg(F.countDistinct("slot"), F.max("slot"))) == [
        (s, 100, 99) for s in range(3)]


def test_items_without_an_id(spark):
    items = spark.createDataFrame([(None, "alpha beta gamma"), ("q", "beta gamma delta"),
                                   (None, "x y")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma delta eps"), (2, "y x")],
                                 "doc_id long, text string")
    for block in (decontaminate.BLOCK_WORDS, 4):
        found = got(decontaminate.report(docs, items, block_words=block))
        one = next(brute.decontamination([(1, "beta gamma delta eps")], [("q", "beta gamma delta")]))
        assert found == [(1, 5, 4, 2, one[4], True), (2, 2, 0, 0, found[1][4], False)]
        assert got(decontaminate.cleaned(docs, items, block_words=block)) == [(1, " eps"),
                                                                              (2, "y x")]


def test_days_first_and_listed_values(spark):
    texts = [(1, "on 25/12/2024 and 12/25/2024"), (2, "no 99/99/2024, 4111111111111112, 000-45-6789"),
             (3, "call 25/12/2024 again"), (4, None), (5, "4111111111111111 and 99/99/2024")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.report(df, "k").collect()}
    first = re.findall(r"\d\d/\d\d/\d{4}", found[1].text)
    assert first[0] != "25/12/2024" and first[1] != "12/25/2024"
    assert int(first[0][3:5]) <= 12 and int(first[1][:2]) <= 12
    # the same day in two orders is the same pseudonym in two orders
    assert first[0][:2] + first[0][3:5] == first[1][3:5] + first[1][:2]
    assert found[1].pseudonyms == first and found[1].n_found == 2
    assert first[0] in found[3].text
    assert found[2].text == texts[1][1] and (found[2].pseudonyms, found[2].n_found) == ([], 0)
    assert found[4].text is None and found[4].n_found == 0
    assert found[5].n_found == 1 and "99/99/2024" in found[5].text


@pytest.mark.parametrize("name", ["made", "m", "found", "whole", "o", "s", "turn", "a`b"])
def test_texts_in_columns_of_any_name(spark, name):
    df = spark.createDataFrame([("mail a.person@example.org on 2024-02-29",)], "text string")
    wanted = pii.pseudonymise(df, "k").first()[0]
    assert wanted != df.first()[0]
    assert pii.pseudonymise(df.withColumnRenamed("text", name), "k", name).first()[0] == wanted


def test_rows_without_an_id_are_judged_by_themselves(spark, table):
    docs = table("documents")
    kept = {r.doc_id for r in perplexity.report(docs).where("kept").collect()}
    some = docs.withColumn("doc_id", F.expr("if(doc_id % 5 = 0, null, doc_id)"))
    left = perplexity.accepted(some)
    assert left.columns == docs.columns
    wanted = docs.where(F.col("doc_id").isin(list(kept)))
    assert left.count() == wanted.count()
    assert left.where("doc_id IS NULL").count() == wanted.where("doc_id % 5 = 0").count() > 0
