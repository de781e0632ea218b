"""Declared schemas of targets and sources, with the names a source column may go by."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "date": T.DateType(),
}


def struct(columns: str) -> T.StructType:
    """Struct from ``name type`` pairs; needs no running session."""
    out = T.StructType()
    for name, kind, p, q in re.findall(r"(\w+) (\w+)(?:\((\d+),(\d+)\))?", columns):
        out.add(name, T.DecimalType(int(p), int(q)) if kind == "decimal" else _TYPES[kind])
    return out


DOCUMENT = struct(
    "access_key string, doc_type int, entry_reg decimal(15,0), entry_state string, entry_muni int,"
    "exit_reg decimal(15,0), exit_state string, exit_muni int, emitted_at timestamp, period int,"
    "total decimal(17,2), value_added decimal(17,2), appropriation string, reason int, run_id bigint"
)
ITEM = struct(
    "access_key string, doc_type int, item_no int, op_code string, product_code string,"
    "quantity decimal(19,4), gross decimal(25,2), discount decimal(15,2), freight decimal(15,2),"
    "insurance decimal(15,2), other decimal(15,2), ipi decimal(15,2), substituted_tax decimal(15,2),"
    "single_phase_tax decimal(15,2), waiver decimal(15,2), import_tax decimal(15,2),"
    "waiver_source string, fuel_code string, value_added decimal(17,2), reason int, run_id bigint"
)
REGISTRY = struct(
    "reg decimal(15,0), state string, muni int, valid_from timestamp, valid_to timestamp,"
    "status string, regime string, rural boolean, rural_only boolean, run_id bigint"
)
VALUE_ADDED = struct(
    "doc_type int, period int, direction string, reg decimal(15,0), muni int,"
    "value_added decimal(19,2), run_id bigint"
)
SHARE_INDEX = struct(
    "year int, stage string, index_type string, muni int, va_muni decimal(20,2),"
    "va_state decimal(20,2), share decimal(22,18), run_id bigint"
)
RUN_EVENT = struct("run_id bigint, job string, at timestamp, status string, counter string, amount bigint, note string")

REFERENCES = {
    "params": struct("name string, value string"),
    "op_codes": struct("code string, participates string"),
    "products": struct("code string, participates string"),
    "events": struct("access_key string, kind string, at timestamp"),
    "municipalities": struct("muni int, parent int, state string, name string"),
}


@dataclass(frozen=True)
class Section:
    """A source table: canonical columns with type, and other names they may arrive under."""

    schema: T.StructType
    time: str | None = None
    time_kind: str = "timestamp"  # timestamp, epoch or mixed
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)


#: Sections that hold the documents themselves, or the items their value is made of.
MAIN_SECTIONS = (
    "goods_header", "goods_item", "transport_doc", "energy_doc", "ticket_doc", "ledger_document", "loose_note",
    "telecom_doc", "telecom_item",
)
SECTIONS = {
    "goods_header": Section(
        struct(
            "access_key string, emitted bigint, model string, environment string, state_code int,"
            "muni int, issuer_company string, issuer_person string, recipient_company string,"
            "recipient_person string"
        ),
        "emitted", "epoch",
        {
            "access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "model": ("ide_mod",),
            "environment": ("ide_tpamb",), "state_code": ("ide_cuf",), "muni": ("ide_cmunfg",),
            "issuer_company": ("emit_cnpj",), "issuer_person": ("emit_cpf",),
            "recipient_company": ("dest_cnpj",), "recipient_person": ("dest_cpf",),
        },
    ),
    "goods_issuer": Section(
        struct("access_key string, emitted bigint, muni string, state string, reg string"),
        "emitted", "epoch",
        {"access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "muni": ("cmun",), "state": ("uf",), "reg": ("ie",)},
    ),
    "goods_recipient": Section(
        struct("access_key string, emitted bigint, muni string, state string, reg string, reg_kind string"),
        "emitted", "epoch",
        {
            "access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "muni": ("cmun",),
            "state": ("uf",), "reg": ("ie",), "reg_kind": ("indiedest",),
        },
    ),
    "goods_total": Section(
        struct(
            "access_key string, emitted bigint, total decimal(17,2), gross decimal(17,2), freight decimal(17,2),"
            "insurance decimal(17,2), discount decimal(17,2), other decimal(17,2), import_tax decimal(17,2),"
            "ipi decimal(17,2), waiver decimal(17,2), substituted_tax decimal(17,2)"
        ),
        "emitted", "epoch",
        {
            "access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "total": ("vnf",), "gross": ("vprod",),
            "freight": ("vfrete",), "insurance": ("vseg",), "discount": ("vdesc",), "other": ("voutro",),
            "import_tax": ("vii",), "ipi": ("vipi",), "waiver": ("vicmsdeson",), "substituted_tax": ("vst",),
        },
    ),
    "goods_item": Section(
        struct(
            "access_key string, emitted bigint, item_no int, op_code string, product_code string,"
            "quantity decimal(19,4), gross decimal(17,2), discount decimal(17,2), freight decimal(17,2),"
            "insurance decimal(17,2), other decimal(17,2), given_value decimal(17,2)"
        ),
        "emitted", "epoch",
        {
            "access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "item_no": ("det_nitem",), "op_code": ("cfop",), "product_code": ("ncm",),
            "quantity": ("qcom",), "gross": ("vprod",), "discount": ("vdesc",), "freight": ("vfrete",),
            "insurance": ("vseg",), "other": ("voutro",), "given_value": ("vl_item",),
        },
    ),
    "goods_item_tax": Section(
        struct(
            "access_key string, emitted bigint, item_no int, st_10 decimal(17,2), st_30 decimal(17,2), st_70 decimal(17,2),"
            "st_90 decimal(17,2), waiver decimal(17,2), mono_02 decimal(17,2), mono_15 decimal(17,2),"
            "mono_15_retained decimal(17,2), mono_53 decimal(17,2), why_40 string, why_30 string,"
            "why_70 string, why_90 string, why_20 string"
        ),
        "emitted", "epoch",
        {
            "access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "item_no": ("det_nitem",), "st_10": ("icms10_vicmsst",), "st_30": ("icms30_vicmsst",),
            "st_70": ("icms70_vicmsst",), "st_90": ("icms90_vicmsst",), "waiver": ("icms40_41_50_vicmsdeson",),
            "mono_02": ("icms02_vicmsmono",), "mono_15": ("icms15_vicmsmono",),
            "mono_15_retained": ("icms15_vicmsmonoreten",), "mono_53": ("icms53_vicmsmono",),
            "why_40": ("icms40_41_50_motdesicms",), "why_30": ("icms30_motdesicms",),
            "why_70": ("icms70_motdesicms",), "why_90": ("icms90_motdesicms",), "why_20": ("icms20_motdesicms",),
        },
    ),
    "goods_item_ipi": Section(
        struct("access_key string, emitted bigint, item_no int, ipi decimal(17,2)"), "emitted", "epoch",
        {"access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "item_no": ("det_nitem",), "ipi": ("ipitrib_vipi",)},
    ),
    "goods_item_import": Section(
        struct("access_key string, emitted bigint, item_no int, import_tax decimal(17,2)"), "emitted", "epoch",
        {"access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "item_no": ("det_nitem",), "import_tax": ("vii",)},
    ),
    "goods_item_fuel": Section(
        struct("access_key string, emitted bigint, item_no int, fuel_code string, fuel_rate decimal(17,4), fuel_base decimal(17,4)"),
        "emitted", "epoch",
        {
            "access_key": ("chavenfe",), "emitted": ("ide_dhemi_nums",), "item_no": ("det_nitem",), "fuel_code": ("cprodanp",),
            "fuel_rate": ("valiqprod",), "fuel_base": ("qbcprod",),
        },
    ),
    "transport_doc": Section(
        struct(
            "access_key string, emitted timestamp, state_code int, environment string, model string,"
            "issuer_company string, issuer_reg string, issuer_muni string, issuer_state string, taker_company string,"
            "taker_person string, taker_reg string, taker_muni string, taker_state string"
        ),
        "emitted", "timestamp",
        {
            "access_key": ("chcte",), "emitted": ("ide_dhemi",), "state_code": ("ide_cuf",), "environment": ("ide_tpamb",),
            "model": ("ide_mod",), "issuer_company": ("emit_cnpj",), "issuer_reg": ("emit_ie",),
            "issuer_muni": ("emit_enderemit_cmun",), "issuer_state": ("emit_enderemit_uf",),
            "taker_company": ("ide_toma4_cnpj",), "taker_person": ("ide_toma4_cpf",), "taker_reg": ("ide_toma4_ie",),
            "taker_muni": ("ide_toma4_endertoma_cmun",), "taker_state": ("ide_toma4_endertoma_uf",),
        },
    ),
    "transport_value": Section(
        struct("access_key string, charged decimal(17,2), received decimal(17,2)"), None, "timestamp",
        {"access_key": ("chcte",), "charged": ("vprest_vtprest",), "received": ("vprest_vrec",)},
    ),
    "transport_event": Section(
        struct("access_key string, kind string, at timestamp"), None, "timestamp",
        {"access_key": ("chcte",), "kind": ("tpEvento",), "at": ("infevento_dhevento",)},
    ),
    "energy_doc": Section(
        struct(
            "access_key string, emitted timestamp, state_code int, model string, environment string,"
            "issuer_reg string, issuer_muni string, issuer_state string, recipient_reg string,"
            "recipient_muni string, recipient_state string"
        ),
        "emitted", "timestamp",
        {
            "access_key": ("chnf3e",), "emitted": ("ide_dhemi",), "state_code": ("ide_cuf",), "model": ("ide_mod",),
            "environment": ("ide_tpamb",), "issuer_reg": ("emit_ie",), "issuer_muni": ("emit_cmun",), "issuer_state": ("emit_uf",),
            "recipient_reg": ("dest_ie",), "recipient_muni": ("dest_cmun",), "recipient_state": ("dest_uf",),
        },
    ),
    "energy_event": Section(
        struct("access_key string, kind string, at timestamp"), None, "timestamp",
        {"access_key": ("chnf3e",), "kind": ("tpevento",), "at": ("dhevento",)},
    ),
    "loose_note": Section(
        struct("access_key string, note_id bigint, emitted timestamp, total decimal(17,2), value decimal(17,2), note_status string"),
        "emitted", "timestamp",
    ),
    "loose_party": Section(struct("note_id bigint, role int, reg string, muni string, state string")),
    "telecom_doc": Section(
        struct(
            "access_key string, emitted timestamp, total decimal(17,2), issuer_reg string, issuer_muni string, issuer_state string,"
            "recipient_reg string, recipient_muni string, recipient_state string"
        ),
        "emitted", "timestamp",
    ),
    "telecom_item": Section(
        struct(
            "access_key string, item_no int, op_code string, rate decimal(9,4), base decimal(17,2), exempt decimal(17,2), situation string"
        )
    ),
    "energy_total": Section(
        struct("access_key string, total decimal(17,2), gross decimal(17,2)"), None, "timestamp",
        {"access_key": ("chnf3e",), "total": ("total_vnf", "vnf", "ggrandfat_vfat"), "gross": ("total_vprod", "vprod", "ggrandfat_vfat")},
    ),
    "energy_item": Section(
        struct(
            "access_key string, item_no bigint, op_code string, energy_class int, consumption_class string,"
            "returned string, value decimal(17,2)"
        ),
        None, "timestamp",
        {
            "access_key": ("id_nf3e",), "item_no": ("id_item_nota_fiscal",), "op_code": ("numr_cfop",),
            "energy_class": ("item_prod_cclass",), "consumption_class": ("tipo_classe_consumo",),
            "returned": ("ind_devolucao",), "value": ("valr_va",),
        },
    ),
    "ticket_doc": Section(
        struct("access_key string, emitted bigint, muni int, state string, op_code string, paid decimal(17,2), listed decimal(17,2)"),
        "emitted", "epoch",
        {
            "access_key": ("chbpe", "id"), "emitted": ("ide_dhemi_nums",), "muni": ("ide_cmunini",), "state": ("ide_ufini",),
            "op_code": ("ide_cfop",), "paid": ("infvalorbpe_vpgto",), "listed": ("infvalorbpe_vbp",),
        },
    ),
    "ticket_event": Section(
        struct("access_key string, kind string, note string"), None, "timestamp",
        {"access_key": ("chbpe", "chave"), "kind": ("tpevento", "cdevento"), "note": ("descevento",)},
    ),
    "ticket_detail": Section(
        struct("access_key string, id bigint, trip_no bigint, listed decimal(17,2), taxed decimal(17,2), op_code string"), None, "timestamp",
        {"access_key": ("chbpe",), "trip_no": ("nviagem",), "listed": ("vbp",), "taxed": ("imp_vtotdfe",), "op_code": ("cfop",)},
    ),
    "ticket_trip": Section(
        struct("access_key string, boarded bigint, prefix string, seat string"), None, "timestamp",
        {"access_key": ("chbpe",), "boarded": ("dhviagem_nums",), "prefix": ("prefixo",), "seat": ("poltrona",)},
    ),
    "ticket_payment": Section(
        struct("access_key string, paid decimal(17,2)"), None, "timestamp", {"access_key": ("chbpe",), "paid": ("vpag",)}
    ),
    "ticket_component": Section(
        struct("access_key string, amount decimal(17,2)"), None, "timestamp", {"access_key": ("chbpe",), "amount": ("vcomp",)}
    ),
    "ledger_document": Section(
        struct("company string, person string, model string, series string, number string, day string, total decimal(17,2)"),
        None, "timestamp",
        {
            "company": ("CNPJ", "reg0000_cnpj"), "person": ("CPF", "reg0000_cpf"), "model": ("COD_MOD",), "series": ("SER",),
            "number": ("NUM_DOC",), "day": ("DT_DOC",), "total": ("VL_DOC",),
        },
    ),
    "ledger_item": Section(
        struct(
            "company string, person string, model string, series string, number string, day string, item_no int,"
            "gross decimal(17,2), discount decimal(17,2), quantity decimal(17,3), ipi decimal(17,2), op_code string"
        ),
        None, "timestamp",
        {
            "company": ("CNPJ", "reg0000_cnpj"), "person": ("CPF", "reg0000_cpf"), "model": ("COD_MOD",), "series": ("SER",),
            "number": ("NUM_DOC",), "day": ("DT_DOC",), "item_no": ("NUM_ITEM",), "gross": ("VL_ITEM",), "discount": ("VL_DESC",),
            "quantity": ("QTD",), "ipi": ("VL_IPI",), "op_code": ("CFOP",),
        },
    ),
    "ledger_period": Section(
        struct("start date, stop date"), None, "timestamp", {"start": ("DT_INI",), "stop": ("DT_FIN",)}
    ),
}

#: Bills may have their totals in up to three tables of one layout; the first that knows a bill counts.
ENERGY_TOTALS = ("energy_total", "energy_total_2", "energy_total_3")
SECTIONS |= dict.fromkeys(ENERGY_TOTALS, SECTIONS["energy_total"])
