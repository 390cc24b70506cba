import hashlib
import os
import sys

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from avionyx.llm.latent import TOKEN
from avionyx.llm.text import WORD, lower_az
from avionyx.session import materialize

sys.path.insert(0, os.path.dirname(__file__))
import test_near_dups  # noqa: E402
import test_quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def passes_quality(text):
    n, chars, symbols, dup, repeat, lines = test_quality.brute(text)
    return not (n < 50 or 100 * repeat > 50 * n or 10 * symbols > n or 100 * dup > 80 * lines or chars < 2 * n or chars > 20 * n)


def runs(text, n):
    words = WORD.findall(lower_az(text))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        rows = docs.collect()
        if name != "encoding":
            assert docs.columns == names
            after = {r["doc_id"]: r["text"] for r in rows}
            assert len(after) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "quality_rules":
            assert after == {d: t for d, t in before.items() if passes_quality(t)}
        elif name == "near_dedup":
            groups = test_near_dups.brute(list(before.items()), 5, 80)
            assert after == {d: before[d] for d, (_, c) in groups.items() if d == c}
        elif name == "substring_dedup":
            # a fuzzy passage holds shorter exact runs: only texts without any must stay as they are
            shared = {}
            for d, t in before.items():
                for run in runs(t, 8):
                    shared.setdefault(run, set()).add(d)
            repeated = {d for ds in shared.values() if len(ds) > 1 for d in ds}
            assert len(repeated) < len(before) / 2
            assert all(after[d] == before[d] for d in before if d not in repeated)
            left = [run for t in after.values() for run in runs(t, 60)]
            assert len(left) == len(set(left))
        elif name == "decontamination":
            asked = [" ".join(TOKEN.findall(t.lower())) for t in items]
            held = {d for d, t in before.items() if any(f" {a} " in f" {' '.join(TOKEN.findall(t.lower()))} " for a in asked)}
            assert after == {d: t for d, t in before.items() if d not in held}
        else:
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = set()
            for d, t in before.items():
                ids = library.encode(t, add_special_tokens=False).ids
                text = library.decode(ids, skip_special_tokens=False)
                want.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
            assert {tuple(r) for r in rows} == want and len(rows) == len(before)
        before = after
