"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from meshfold.llm import decontamination, extraction, forest, infill, lines, neighbours, packing, periodic, quality, secrets, sharding, simhash, warc

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_sharding": sharding.op2_sharding,
    "op3_quality": quality.op3_quality,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_simhash": simhash.op5_simhash,
    "op6_neighbours": neighbours.op6_neighbours,
    "op7_packing": packing.op7_packing,
    "op8_secrets": secrets.op8_secrets,
    "op9_warc": warc.op9_warc,
    "op10_extraction": extraction.op10_extraction,
    "op11_minhash_forest": forest.op11_minhash_forest,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op1_decontamination": decontamination.SQL,
    "op8_secrets": secrets.SQL,
    "op11_minhash_forest": forest.SQL,
    "op12_fill_in_middle": infill.SQL,
}
