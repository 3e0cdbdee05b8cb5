"""The training-data operators as named queries, and the SQL some of them are checked against."""

from __future__ import annotations

import corpus_pipeline
from editstream.llm import (
    bpe,
    collocations,
    conversations,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    main_text,
    near_dedup,
    neighbours,
    repeats,
    secrets,
    warc,
)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_licenses": licenses.op3_licenses,
    "op4_repeats": repeats.op4_repeats,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_language": language_id.op6_language,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_secrets": secrets.op9_secrets,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_collocations": collocations.op11_collocations,
    "op12_main_text": main_text.op12_main_text,
    "op13_conversations": conversations.op13_conversations,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_warc": warc.SQL,
    "op2_decontaminate": decontaminate.SQL,
    "op3_licenses": licenses.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op9_secrets": secrets.SQL,
    "op11_collocations": collocations.SQL,
}
