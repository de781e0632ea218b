"""Row rules: item value, appropriation, exclusion reasons, labels (Column -> Column)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from apportia import constants as K
from apportia.functions.codes import col

MONEY = "decimal(17,2)"


def amount(c: Column | str | None) -> Column:
    """Missing column or null counts as zero."""
    zero = F.lit(0).cast(MONEY)
    return zero if c is None else F.coalesce(col(c).cast(MONEY), zero)


def total(*cols: Column | str | None) -> Column:
    return reduce(lambda a, b: a + b, [amount(c) for c in cols])


def item_value(
    gross, freight=None, insurance=None, other=None, ipi=None, substituted=None,
    discount=None, waiver=None, import_tax=None, given=None,
) -> Column:
    """Given value if present, else gross plus charges minus discount and waiver."""
    computed = (
        total(gross, freight, insurance, other, ipi, substituted, import_tax)
        - total(discount, waiver)
    ).cast(MONEY)
    return computed if given is None else F.coalesce(col(given).cast(MONEY), computed)


def fuel_item_value(
    fuel_code, gross, discount=None, waiver=None, substituted=None, retained=None,
    freight=None, insurance=None, other=None, ipi=None, import_tax=None,
) -> Column:
    """Item value added; for fuels the substituted and the retained single-phase tax are added."""
    base = total(gross, freight, insurance, other, ipi, import_tax) - total(discount, waiver)
    prefix = F.substring(col(fuel_code).cast("string"), 1, 2)
    extra = F.when(prefix.isin(*K.FUEL_PREFIXES), total(substituted, retained))
    return (base + F.coalesce(extra, F.lit(0).cast(MONEY))).cast(MONEY)


def ledger_item_value(gross, discount, ipi) -> Column:
    return (amount(gross) - amount(discount) - amount(ipi)).cast(MONEY)


def telecom_value(rate, base, exempt) -> Column:
    """Base plus exempt amount where both rate and base are set, else zero."""
    taxed = (col(rate) != 0) & (col(base) != 0)
    return F.when(taxed, amount(base) + amount(exempt)).otherwise(F.lit(0)).cast(MONEY)


def energy_value(value, class_direction, returned) -> Column:
    """Outgoing classes and returns flip the sign; both together cancel out."""
    sign = F.when(col(class_direction) == "S", -1).otherwise(1) * F.when(
        col(returned) == "1", -1
    ).otherwise(1)
    return (amount(value) * sign).cast(MONEY)


def value_or_zero(value, participates, given=None) -> Column:
    fallback = F.when(col(participates), amount(value)).otherwise(F.lit(0).cast(MONEY))
    return fallback if given is None else F.coalesce(col(given).cast(MONEY), fallback)


def transport_discount(charged, received) -> Column:
    return col(charged).cast(MONEY) - col(received).cast(MONEY)


# Waiver groups in order of precedence.
WAIVER_GROUPS = ("ICMS40_41_50", "ICMS30", "ICMS70", "ICMS90", "ICMS20")


def waiver_source(reasons: dict[str, Column | str]) -> Column:
    """Name of the first group that carries a waiver reason."""
    return F.coalesce(
        *[F.when(col(reasons[g]).isNotNull(), F.lit(g)) for g in WAIVER_GROUPS if g in reasons]
    )


def is_active(status) -> Column:
    return F.coalesce(col(status).cast("string") == K.ACTIVE, F.lit(False))


def is_simplified(regime) -> Column:
    return F.coalesce(col(regime).cast("string").isin(*K.SIMPLIFIED_REGIMES), F.lit(False))


def is_eligible(status, regime, rural) -> Column:
    """Active and either normal or rural."""
    return is_active(status) & (~is_simplified(regime) | F.coalesce(col(rural), F.lit(False)))


def appropriation(entry: tuple, exit_: tuple) -> Column:
    """A both sides, E entry, S exit, N none; each side given as (status, regime, rural)."""
    e, s = is_eligible(*entry), is_eligible(*exit_)
    return F.when(e & s, "A").when(e, "E").when(s, "S").otherwise("N")


def party_out(status, regime) -> Column:
    return ~is_active(status) | is_simplified(regime)


def both_parties_out(entry: tuple, exit_: tuple) -> Column:
    """Each side given as (status, regime)."""
    return party_out(*entry) & party_out(*exit_)


def taxpayer_class(rural, status, regime) -> Column:
    """Rural, unregistered, normal or simplified; a null status falls through to the regime."""
    r = col(regime).cast("string")
    return (
        F.when(col(rural), "RURAL")
        .when(col(status).cast("string") != K.ACTIVE, "UNREGISTERED")
        .when(r.isin("1", "2"), "NORMAL")
        .when(r.isin(*K.SIMPLIFIED_REGIMES), "SIMPLIFIED")
        .otherwise("UNREGISTERED")
    )


def document_reason(cancelled, substituted, code_participates=None, product_and_rural=None) -> Column:
    """Reason by precedence; null means the document participates."""
    out = F.when(col(cancelled), K.CANCELLED).when(col(substituted), K.SUBSTITUTED)
    if code_participates is not None:
        rescued = F.lit(False) if product_and_rural is None else col(product_and_rural)
        out = out.when(~col(code_participates) & ~rescued, K.NO_ITEM_LEFT)
    return out.cast("int")


def ticket_reason(cancelled, not_boarded, given=None) -> Column:
    out = F.when(col(cancelled), K.CANCELLED).when(col(not_boarded), K.INCONSISTENT_VALUES)
    return (out if given is None else out.otherwise(F.nullif(col(given), F.lit(0)))).cast("int")


def home_side(issuer_state, recipient_state, header_state, home: str = K.HOME_STATE) -> Column:
    """ISSUER or RECIPIENT, whichever is in the home state, issuer first; null when neither is."""
    issuer, header = col(issuer_state), col(header_state)
    return (
        F.when((issuer == home) | (issuer.isNull() & (header == home)), "ISSUER")
        .when(col(recipient_state) == home, "RECIPIENT")
    )


def by_direction(is_entry: Column, own, other) -> Column:
    """Own value on an entry document, the other party's otherwise."""
    return F.when(is_entry, col(own)).otherwise(col(other))


def appropriation_label(c) -> Column:
    return (
        F.when(col(c) == "E", "Entry").when(col(c) == "S", "Exit")
        .when(col(c) == "A", "Entry and exit").otherwise("None")
    )


def purpose_label(c) -> Column:
    return (
        F.when(col(c) == 1, "Normal").when(col(c) == 2, "Complementary")
        .when(col(c) == 3, "Adjustment").when(col(c) == 4, "Return").otherwise("Unknown")
    )


def loose_destination_label(c) -> Column:
    return (
        F.when(col(c) == 1, "Internal").when(col(c) == 2, "Interstate")
        .when(col(c) == 3, "Foreign").otherwise("Unknown")
    )


def loose_purpose_label(c) -> Column:
    return (
        F.when(col(c).isin(1, 2, 3), "Normal").when(col(c) == 4, "Complementary")
        .when(col(c) == 5, "Return").otherwise("Unknown")
    )


def reason_text(c) -> Column:
    from apportia.functions.codes import lookup

    return lookup(col(c).cast("int"), K.REASON_TEXT)


def mirrored_op_code(c) -> Column:
    from apportia.functions.codes import lookup

    both = {**K.MIRRORED_OP_CODES, **{v: k for k, v in K.MIRRORED_OP_CODES.items()}}
    return lookup(col(c).cast("int"), both)
