"""Codes and lists that decide results."""

HOME_STATE = "GO"

# Exclusion reasons. 1-4 are item level, 10-14 document level.
OP_CODE_OUT = 1
ENERGY_CLASS_OUT = 2
FIXED_ASSET = 3
DUPLICATE_OPERATION = 4
CANCELLED = 10
PARTIES_OUT = 11
NO_ITEM_LEFT = 12
SUBSTITUTED = 13
INCONSISTENT_VALUES = 14

REASON_TEXT = {
    1: "operation code not participating",
    2: "energy class not participating",
    3: "fixed asset",
    4: "duplicate operation",
    10: "document cancelled",
    11: "both parties unregistered or simplified",
    12: "no participating item",
    13: "document substituted",
    14: "inconsistent values",
}

# Document types.
CONSUMER_INVOICE = 1
RECEIVED_INVOICE = 2
ENERGY = 3
LOOSE_INVOICE = 4
LEDGER = 5
TELECOM = 6
TICKET = 7
TRANSPORT = 8
ASSESSMENT = 9
ISSUED_INVOICE = 10
SIMPLIFIED = 11
MICRO_ENTREPRENEUR = 12
SPECIAL = 13
DOCUMENT_TYPES = tuple(range(1, 14))

# Index types and stages accepted by the index import.
INDEX_FULL = "1"
INDEX_TYPES = ("1", "5", "7", "M", "I", "V", "E", "S", "F")
INDEX_STAGES = ("P", "D")

# Registry status and regime codes.
STATUS_CODE = {
    "Ativo": "1",
    "Suspenso": "2",
    "Baixado": "3",
    "Paralisado": "4",
    "Cassado": "5",
    "Anulado": "6",
}
REGIME_CODE = {
    "Microempresa": "1",
    "Normal": "2",
    "Micro EPP/Simples Naciona": "3",
    "Simples Nacional/SIMEI": "4",
    "Simples Nacional/Normal": "5",
}
ACTIVE = "1"
SIMPLIFIED_REGIMES = ("3", "4", "5")

# Federal state codes.
STATE_BY_CODE = {
    11: "RO", 12: "AC", 13: "AM", 14: "RR", 15: "PA", 16: "AP", 17: "TO",
    21: "MA", 22: "PI", 23: "CE", 24: "RN", 25: "PB", 26: "PE", 27: "AL",
    28: "SE", 29: "BA", 31: "MG", 32: "ES", 33: "RJ", 35: "SP", 41: "PR",
    42: "SC", 43: "RS", 50: "MS", 51: "MT", 52: "GO", 53: "DF",
}

# Exit operation code and the entry code that mirrors it.
MIRRORED_OP_CODES = {
    5101: 1101, 5102: 1102, 5116: 1116, 5201: 1201, 5202: 1202, 5410: 1410,
    6101: 2101, 6102: 2102, 6116: 2116, 6201: 2201, 6202: 2202, 6410: 2410,
}

# Product prefixes taxed as fuel: substituted and retained tax is added.
FUEL_PREFIXES = ("32", "42", "82")

# Event type codes and text tokens.
EVENT_CANCEL = ("110111",)
EVENT_CORRECTION = ("110110",)
EVENT_VOID = ("110112",)
EVENT_SUBSTITUTE = ("110140", "110160", "240650")
# What an event does to its document, by its code or by a word of its text.
EVENT_KINDS = ("cancelled", "substituted", "corrected", "voided")
EVENT_KIND_OF_CODE = (
    dict.fromkeys(EVENT_CANCEL, "cancelled") | dict.fromkeys(EVENT_SUBSTITUTE, "substituted")
    | dict.fromkeys(EVENT_CORRECTION, "corrected") | dict.fromkeys(EVENT_VOID, "voided")
)
EVENT_KIND_OF_WORD = {
    "CANCEL": "cancelled", "CARTA": "corrected", "CCE": "corrected", "CORRECAO": "corrected", "CORREÇÃO": "corrected",
    "INUTIL": "voided", "SUBST": "substituted",
}
TRANSPORT_SUBSTITUTE = ("110165", "110170")
TRANSPORT_VOID = ("110",)
ENERGY_SUBSTITUTE = ("110112",)
TICKET_STOP_EVENTS = ("110111", "110115", "240140")
NO_BOARDING_TEXT = "NAO EMBARQUE"

# Yes / no spellings of text flags.
YES = ("S", "1", "TRUE", "T", "SIM", "Y")
NO = ("N", "0", "FALSE", "F", "NAO", "NÃO", "NAO.")

# Declarations: activity types that count and the share of revenue they count for.
DECLARATION_ACTIVITIES = (0, 1, 2, 3, 4, 5, 6, 34, 35, 36, 37, 38, 39)
DECLARATION_SHARE = "0.32"

# Municipality sentinel and remap of the loose-invoice source.
NO_CODE = 999999999
MUNI_REMAP = {216100: 175400}

# Ledger situations kept on entry notes.
LEDGER_SITUATIONS = (0, 1, 6, 7, 8)

# Status of an authorised invoice.
AUTHORISED = 321

# Operation codes of the simplified-regime study, exit and entry side.
STUDY_EXIT_CODES = (
    5101, 5102, 5103, 5104, 5105, 5106, 5109, 5110, 5111, 5112, 5113, 5114,
    5115, 5116, 5117, 5118, 5119, 5120, 5122, 5123, 5129, 5251, 5252, 5253,
    5254, 5255, 5256, 5257, 5258, 5401, 5402, 5403, 5405, 5651, 5652, 5653,
    5654, 5655, 5656, 5667, 6101, 6102, 6103, 6104, 6105, 6106, 6107, 6108,
    6109, 6110, 6111, 6112, 6113, 6114, 6115, 6116, 6117, 6118, 6119, 6120,
    6122, 6123, 6129, 6251, 6252, 6253, 6254, 6255, 6256, 6257, 6258, 6401,
    6402, 6403, 6404, 6651, 6652, 6653, 6654, 6655, 6656, 6667, 7101, 7102,
    7105, 7106, 7127, 7129, 7651, 7654, 7667,
)
STUDY_ENTRY_CODES = (
    1101, 1102, 1111, 1113, 1116, 1117, 1118, 1120, 1121, 1122, 1251, 1252,
    1253, 1254, 1255, 1256, 1257, 1401, 1403, 1651, 1652, 1653, 2101, 2102,
    2111, 2113, 2116, 2117, 2118, 2120, 2121, 2122, 2251, 2252, 2253, 2254,
    2255, 2256, 2257, 2401, 2403, 2651, 2652, 2653, 3101, 3102, 3127, 3129,
    3652,
)

# Columns of the registry change log that move an attribute: (table, column).
LOG_STATUS = ("CCE_CONTRIBUINTE", "INDI_SITUACAO_CADASTRAL")
LOG_MUNICIPALITY = ("GEN_ENDERECO", "CODG_MUNICIPIO")
LOG_STREET = ("GEN_ENDERECO", "CODG_LOGRADOURO")
LOG_ACTIVITY_ADDED = ("CCE_CONTRIB_CNAEF", "ID_CONTRIB_CNAEF")
LOG_ACTIVITY_REMOVED = ("CCE_CONTRIB_CNAEF", "ID_SUBCLASSE_CNAEF")
