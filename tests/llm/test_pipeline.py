"""The pipeline's stages as ``run`` chains them, against plain versions."""

import zlib
from collections import Counter

import numpy as np
from test_lines_and_mix import plain_lines
from test_near_dedup import brute
from tokenizers import Tokenizer

import corpus_pipeline
from sessile.llm.line_dedup import drop_lines
from sessile.llm.near_dedup import drop_near_duplicates, near_duplicates
from sessile.llm.queries import packing_params
from sessile.llm.storage import materialize


def plain_drop_lines(rows):
    gone, out = plain_lines(rows), {}
    for d, text in rows:
        lines = (text or "").split("\n")
        left = [x for n, x in enumerate(lines) if (d, n) not in gone]
        own = [gone[d, n] for n in range(len(lines)) if (d, n) in gone]
        if own and not "".join(left).encode().split():
            if all(own):
                continue
            left = lines
        elif own and len("\n".join(left).encode().split()) <= 0.65 * len(text.encode().split()):
            left = lines
        out[d] = text if text is None else "\n".join(left)
    return out


def test_document_of_a_template_stays_unless_it_is_a_copy(spark):
    names = ["anna", "berta", "clara", "dora", "emma", "frieda"]
    rows = [(i, f"user logged in as {n} from the north gate today") for i, n in enumerate(names)]
    rows += [(10 + i, "the very same line in all of these documents here") for i in range(6)]
    rows += [(20, rows[1][1]), (21, rows[0][1])]
    left = {r.doc_id: r.text for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert left == plain_drop_lines(rows) == {d: t for d, t in rows if d not in range(11, 16) and d != 21}


def test_near_copies_reach_near_dedup(spark):
    """Of documents that near dedup drops alone, line dedup cuts down few: both stages together let few survive."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    alone = {r.doc_id for r in near_duplicates(docs).filter("not kept").collect()}
    assert len(alone) > 50
    both = {r.doc_id for r in drop_near_duplicates(materialize(drop_lines(docs), "lines")).select("doc_id").collect()}
    assert len(alone & both) < 5
    # A passage of two documents still goes from the second one, where the rest is its own.
    rng = np.random.default_rng(0)
    passage, own = " ".join(f"p{i}" for i in range(60)), [" ".join(f"v{x}" for x in rng.integers(0, 9999, 150)) for _ in range(2)]
    out = {r.doc_id: r.text for r in drop_lines(spark.createDataFrame([(1, own[0] + "\n" + passage), (2, own[1] + "\n" + passage)], "doc_id long, text string")).collect()}
    assert out == {1: own[0] + "\n" + passage, 2: own[1]}


def test_run_matches_plain_stages(spark, sf, monkeypatch):
    seen, write = {}, corpus_pipeline.materialize

    def recorded(df, name):
        out = write(df, name)
        if name.startswith("stage-"):
            seen[name[6:]] = out.collect()
        return out

    monkeypatch.setattr(corpus_pipeline, "materialize", recorded)
    pieces = corpus_pipeline.run(spark, sf).collect()
    source = spark.read.parquet(f"{sf}/documents.parquet").collect()
    good = seen["quality_classifier"]
    assert set(good) <= set(source) and len(source) / 2 < len(good) < len(source)
    lines = {r.doc_id: r.text for r in seen["line_dedup"]}
    assert lines == plain_drop_lines([(r.doc_id, r.text) for r in good])
    near = {r.doc_id: r.text for r in seen["near_dedup"]}
    kept = {d for d, _, component in brute(list(lines.items())) if d == component}
    assert near == {d: t for d, t in lines.items() if d in kept}
    mixed = seen["mixing"]
    reads = Counter(r.doc_id for r in mixed)
    assert set(reads) <= set(near) and max(reads.values()) <= 3
    exact, cfg, expected = Tokenizer.from_file(packing_params().json_path), packing_params(), Counter()
    for r in mixed:
        ids = np.array([*exact.encode(r.text or "", add_special_tokens=False).ids, cfg.end_id], dtype="<u4")
        cuts = [0, *range(len(ids) - (len(ids) - 1) // cfg.length * cfg.length, len(ids) + 1, cfg.length)]
        expected.update((r.doc_id, k, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in pieces) == expected
