"""The queries of this subpackage and their SQL, as the driver's entry adds them."""

from __future__ import annotations

from tarn.llm import bpe, decontaminate, exact, html, lines, minhash, quality, secrets, shards, tokenfile


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_shards": shards.op2_shards,
    "op3_html": html.op3_html,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_exact_dedup": exact.op5_exact_dedup,
    "op6_token_file": tokenfile.op6_token_file,
    "op7_minhash": minhash.op7_minhash,
    "op8_quality": quality.op8_quality,
    "op9_secrets": secrets.op9_secrets,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "pipeline": pipeline,
}

SQL = {"op4_line_dedup": lines.SQL, "op5_exact_dedup": exact.SQL}
