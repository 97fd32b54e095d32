"""The corpus queries and their DuckDB SQL, by name."""

from __future__ import annotations

from contrail.llm import (
    chat,
    decontamination,
    licenses,
    merkle,
    mixing,
    pii,
    repair,
    secrets,
    sharding,
    simhash,
    topk,
    toxicity,
    warc,
)


def queries() -> dict:
    found = [
        toxicity.op1_mil_toxicity,
        mixing.op2_golden_mix,
        warc.op3_warc_store,
        decontamination.op4_cgk_decontamination,
        simhash.op5_simhash,
        chat.op6_reply_trees,
        secrets.op7_trigram_secrets,
        sharding.op8_byte_shards,
        licenses.op9_license_dice,
        topk.op10_exact_topk,
        pii.op11_crf_pii,
        repair.op12_structure_repair,
        merkle.op13_merkle_manifest,
    ]
    return {fn.__name__: fn for fn in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_golden_mix": mixing.ORACLE_SQL,
        "op3_warc_store": warc.ORACLE_SQL,
        "op6_reply_trees": chat.ORACLE_SQL,
        "op9_license_dice": licenses.ORACLE_SQL,
        "op10_exact_topk": topk.ORACLE_SQL,
        "op12_structure_repair": repair.ORACLE_SQL,
        "op13_merkle_manifest": merkle.ORACLE_SQL,
    }
