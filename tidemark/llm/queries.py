"""The queries of this package and their SQL."""

from tidemark.llm import fingerprints, licenses, lines, media, mixing, near, phrases, pieces, toxicity, urls

QUERIES = {
    "op1_urls": urls.op1_urls,
    "op2_mixing": mixing.op2_mixing,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_phrases": phrases.op4_phrases,
    "op5_media": media.op5_media,
    "op6_near": near.op6_near,
    "op7_lines": lines.op7_lines,
    "op8_licenses": licenses.op8_licenses,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_sentencepiece": pieces.op10_sentencepiece,
}

#: Left out: what SQL cannot say (3, 4, 5, 6, 9, 10); tests hold those against brute force.
SQL: dict[str, str] = {
    "op1_urls": urls.sql(),
    "op2_mixing": mixing.sql(),
    "op7_lines": lines.sql(),
    "op8_licenses": licenses.sql(),
}
