"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from jobstrata.llm import encoding, history, leaks, names, residue, truncation

QUERIES = {
    "p1_found": history.p1_found,
    "p3_found": residue.p3_found,
    "p4_found": names.p4_found,
    "p4_groups": names.p4_groups,
    "p5_found": residue.p5_found,
    "p6_ids": encoding.p6_ids,
    "p6_decoded": encoding.p6_decoded,
    "p7_found": leaks.p7_found,
    "p8_found": truncation.p8_found,
    "p8_shares": truncation.p8_shares,
}
SQL = {
    "p1_found": history.P1_SQL,
    "p6_decoded": encoding.P6_DECODED_SQL,
}
