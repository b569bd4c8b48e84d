"""Column expressions of the completeness rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldfit.config import FIRST_SALE_LABEL, INSTALLED, NOT_INSTALLED, CompletenessRules

ONBOARDING, ICP, SMB = "Onboarding", "ICP", "SMB"


def install_status(service_date: Column, has_order: Column, start: Column) -> Column:
    """Installed from the contract start on, or an order without a date yet."""
    done = F.when(service_date.isNotNull(), service_date.cast("date") >= start).otherwise(has_order)
    return F.when(done, INSTALLED).otherwise(NOT_INSTALLED)


def segment(first_sale_days: Column, potential: Column, rules: CompletenessRules) -> Column:
    """NULL days or NULL potential fall through to SMB."""
    return (
        F.when(first_sale_days <= rules.onboarding_days, ONBOARDING)
        .when(potential > rules.icp_potential_over, ICP)
        .otherwise(SMB)
    )


def target_qty(group: Column, shipped: Column, contracted: Column) -> Column:
    return F.when(group == "TROCA", shipped).otherwise(contracted)


def pending(target: Column, installed: Column) -> Column:
    return F.greatest(target - installed, F.lit(0))


def pct(installed: Column, target: Column, digits: int = 2) -> Column:
    """Share capped at 1; a zero target gives 1 because LEAST skips NULL."""
    share = installed.cast("double") / F.nullif(target.cast("double"), F.lit(0.0))
    return F.least(F.round(share, digits), F.lit(1.0))


def eligible(seg: Column, deal_class: Column) -> Column:
    first_sale = deal_class.contains(FIRST_SALE_LABEL)
    return F.when(seg == ONBOARDING, first_sale).when(seg.isin(ICP, SMB), ~first_sale).otherwise(False)


def _window_days(seg: Column, rules: CompletenessRules) -> Column:
    return F.when(seg == ONBOARDING, rules.onboarding_days).otherwise(rules.other_days)


def in_time(seg: Column, signed_days: Column, rules: CompletenessRules) -> Column:
    return F.when(seg.isin(ONBOARDING, ICP, SMB), signed_days <= _window_days(seg, rules)).otherwise(False)


def days_left(seg: Column, signed_days: Column, rules: CompletenessRules) -> Column:
    return _window_days(seg, rules) - signed_days


def scale(seg: Column, potential: Column, rules: CompletenessRules) -> Column:
    """Grade scale: by segment, and by potential while onboarding."""
    rich = F.coalesce(potential, F.lit(0)) > rules.icp_potential_over
    return F.when((seg == ICP) | ((seg == ONBOARDING) & rich), ICP).otherwise(SMB)


def grade(share: Column, scale_col: Column, rules: CompletenessRules) -> Column:
    whole = F.round(share * 100)

    def ladder(s):
        return (
            F.when(whole == 0, 0)
            .when(whole <= s.grade_1_max, 1)
            .when(whole <= s.grade_2_max, 2)
            .when(whole <= s.grade_3_max, 3)
            .otherwise(4)
        )

    return F.when(scale_col == SMB, ladder(rules.smb_scale)).otherwise(ladder(rules.icp_scale))


def gap(threshold: Column | Decimal, target: Column, installed: Column) -> Column:
    """Installations missing until the threshold share, in whole units."""
    share = threshold if isinstance(threshold, Column) else F.lit(threshold)
    needed = F.ceil(share * target.cast("decimal(20,4)")).cast("bigint")
    return F.greatest(needed - installed, F.lit(0))


def grade_3_floor(scale_col: Column, rules: CompletenessRules) -> Column:
    return F.when(scale_col == SMB, F.lit(rules.smb_scale.grade_3_floor)).otherwise(
        F.lit(rules.icp_scale.grade_3_floor)
    )
