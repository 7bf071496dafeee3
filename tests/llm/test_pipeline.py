import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from messy import clashing, empty, untouched  # noqa: E402
from test_jaccard_join import brute  # noqa: E402

from plumbline.llm import byte_bpe, jaccard_join, mixing, quality, secrets  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect_on_what_the_last_one_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(k.columns == docs.columns for k in kept[:-1])
    good, single, masked, mixed, tokens = (k.collect() for k in kept[1:])
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stays = {r.doc_id for r in good}
    assert sum((i in stays) == bool(q) for i, q in known.items()) >= 0.95 * len(known)
    groups = brute([(r.doc_id, r.text) for r in good], 5, 80)
    assert sorted(r.doc_id for r in single) == sorted(i for i, _, c in groups if i == c)
    assert len(masked) == len(single)
    assert not any(r.n_assign + r.n_access + r.n_hex for r in secrets.report(kept[3]).collect())
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in masked} and all(r.n_chars == len(r.text) for r in mixed)
    own = byte_bpe.tokenizer(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"), corpus_pipeline.public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.ids) for r in tokens) == sorted((r.doc_id, own.encode_ordinary(r.text)) for r in mixed)
    assert corpus_pipeline.run(spark, SF).count() == len(tokens)


def test_no_stage_changes_a_column_that_is_not_its_own(spark):
    docs = clashing(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {(r.doc_id, r.tag): r for r in docs.collect()}

    good = quality.kept_documents(docs, labels)
    single = jaccard_join.one_of_each(docs, 5, 80)
    masked = secrets.redacted(docs)
    mixed = mixing.mixed_documents(docs)
    for out in (good, single, masked, mixed):
        assert out.schema.simpleString() == docs.schema.simpleString()
        rows = out.collect()
        assert rows and untouched(rows)
    assert all(r == known[r.doc_id, r.tag] for out in (good, single) for r in out.collect())
    assert sorted((r.doc_id, r.tag) for r in masked.collect()) == sorted(known)
    assert {r.tag for r in mixed.collect()} == {"one", "two"}  # rows that differ only there are mixed each for itself
    for stage in (lambda d: quality.kept_documents(d, labels), jaccard_join.one_of_each, secrets.redacted, mixing.mixed_documents):
        assert stage(clashing(spark, empty(spark))).count() == 0


def test_a_label_of_many_copies_is_learnt_alike(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    x = quality.measures(docs, "doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    hot = x
    for _ in range(4):
        hot = hot.union(x.where("doc_id % 7 = 3"))
    one, two = (quality.learn(rows.repartition(k), labels, most=100) for rows, k in ((x, 3), (hot, 5)))
    sample = x.limit(50)
    a, b = ({r.doc_id: r.score for r in quality.score(sample, m).collect()} for m in (one, two))
    assert a == b


def test_texts_are_judged_where_they_lie(spark, capsys):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    good = quality.kept_documents(docs, labels)
    good.explain()
    plan = capsys.readouterr().out
    assert "Filter" in plan and "Join" not in plan and "Exchange" not in plan
    scores = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i, s in scores.items() if s >= 0.5)


def test_tokens_are_tested_once(spark, capsys):
    secrets.redacted(spark.createDataFrame([(1, "key a8F3kq9ZpL2mX7vB4tRw"), (2, None)], "doc_id long, text string")).explain()
    assert "1.330274429" not in capsys.readouterr().out  # of the tests' tail
