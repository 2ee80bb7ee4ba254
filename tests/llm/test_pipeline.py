"""The pipeline's stages and its result against brute force on a small corpus."""

import random
import zlib
from collections import Counter

import corpus_pipeline
from conformity.llm import decontaminate

from .helpers import DOCS, awkward, words
from .test_small_ops import brute_quality, ids, packed, tokenizer  # noqa: F401
from .test_text_ops import brute_components, passages, variants

LENGTH = 400


def without_repeats(rows):
    seen = Counter()
    texts = [(r[1] or "").encode() for r in rows]
    for t in texts:
        seen.update(t[i : i + LENGTH] for i in range(len(t) - LENGTH + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        out.append((r[0], bytes(x for x, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore"), *r[2:]))
    return out


def corpus():
    rng = random.Random(21)
    items = [(i, words(rng, 30, 10**6)) for i in range(5)]
    rows = [r for r in passages(rng) if r[0] is not None and r[0] != 4]
    rows += [(300 + i, t, "en", "s", 1) for i, t in enumerate(variants(rng, words(rng, 80, 10**6), 12, 10))]
    rows += [(400 + i, f"{words(rng, 40, 10**6)} {items[i % 5][1]} {words(rng, 40, 10**6)}", "en", "s", 1) for i in range(6)]
    rows += [(500, "few words", "en", "s", 1), (501, "a b c d e " * 40, "en", "s", 1)]
    return rows, items


def test_pipeline_matches_brute_force(spark, tmp_path, tokenizer):  # noqa: F811
    rows, items = corpus()
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    sf_dir = f"file://{tmp_path}"

    # too few labels certify a cutoff, so the base rules decide
    want = []
    for r in rows:
        n, _, _, _, repeated = brute_quality(r[1])
        if n >= 10 and 100 * repeated <= 20 * n:
            want.append(r)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = [want]
    component = {d: c for d, _, c in brute_components(want)}
    expected.append([r for r in want if component[r[0]] == r[0]])
    expected.append(without_repeats(expected[-1]))
    index = decontaminate.SeedIndex(items)
    expected.append([r for r in expected[-1] if not any(" ".join(decontaminate.WORD.findall(t.lower())) in " ".join(decontaminate.WORD.findall(r[1].lower())) for _, t in items)])
    assert len(index.ids) == 5 and len({len(e) for e in expected}) == 3
    for (name, stage), rest in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        out = stage(spark, docs, sf_dir)
        assert out.columns == [c.split()[0] for c in DOCS.split(", ")], name
        assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r[0], r[1]) for r in rest), name
        out.write.parquet(f"{sf_dir}/{name.replace(' ', '')}")
        docs = spark.read.parquet(f"{sf_dir}/{name.replace(' ', '')}")

    pieces = Counter()
    for r in expected[-1]:
        whole, at, k = ids(tokenizer, r[1]), 0, 0
        while at < len(whole):
            size = len(whole) if len(whole) <= 2048 else (len(whole) % 2048 or 2048) if at == 0 else 2048
            pieces[r[0], k, at, size, zlib.crc32(packed(whole[at : at + size]))] += 1
            at, k = at + size, k + 1
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in final) == pieces


def test_stages_take_awkward_rows_and_empty_tables(spark, tmp_path):
    rng = random.Random(22)
    items = [(1, words(rng, 30)), (2, None)]
    for name, rows, schema in (("labels", [], "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/{name}.parquet")
    for rows in (awkward(rng), []):
        docs = spark.createDataFrame(rows, DOCS)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, f"file://{tmp_path}")
            out.count()
            if out.columns == docs.columns:
                path = f"file://{tmp_path}/{rng.random()}"
                out.write.parquet(path)
                docs = spark.read.parquet(path)
