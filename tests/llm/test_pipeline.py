import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lexmill.llm import secrets, simhash
from tests.llm.helpers import DOCS
from tests.llm.test_mixing import plain_targets
from tests.llm.test_simhash import plain_components, plain_fingerprint

HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def corpus(spark):
    rng = random.Random(11)
    syllables = "the and of ing tion ed ly er th sh ou re".split()
    text = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))
    rows = [(i, text(rng.choice([40, 90, 300])), "en", f"src{i % 5}", 0) for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "src1", 0) for i in range(0, 60, 2)]
    rows += [(300 + i, rows[i][1] + f" token = {HEX}", "en", "src2", 0) for i in range(100, 120)]
    rows += [(500, None, "en", "src0", 0), (501, "", "en", None, 0), (502, "123 ... 4", None, "src0", 0)]
    return spark.createDataFrame([(*r[:4], len(r[1] or "")) for r in rows], DOCS), {r[0]: r for r in rows}


def test_stages_against_plain_versions(spark, tmp_path):
    frame, rows = corpus(spark)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    results = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        results.append(docs)
        if number < 4:
            assert docs.columns == frame.columns
    known, single, clean, mixed, packed = (r.collect() for r in results)

    want = sorted(i for i, r in rows.items() if r[1] and any(map(str.isalpha, r[1])))
    assert sorted(r.doc_id for r in known) == want

    groups = plain_components([plain_fingerprint(rows[i][1]) for i in want])
    assert sorted(r.doc_id for r in single) == sorted({want[g] for g in groups})

    assert sorted((r.doc_id, r.text) for r in clean) == sorted((r.doc_id, secrets.redacted(r.text)) for r in single)
    assert all(r.n_chars == len(r.text) and HEX not in r.text for r in clean)

    sizes, taken = {}, {}
    for r in clean:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    target = plain_targets(sizes)
    assert all(abs(taken[s] - target[s]) <= max(0.05 * target[s], 450) for s in sizes)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(r.length for r in packed) == total == sum(len(np.frombuffer(r.ids, "<u4")) for r in packed)


def test_run_and_empty_tables(spark, tmp_path):
    frame, _ = corpus(spark)
    frame.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language id", "near-duplicates", "secrets", "mixing", "packing"]
    assert simhash.BITS == 64
