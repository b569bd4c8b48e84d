"""Row visibility as joins with what a viewer may see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldfit.config import GENERAL_MANAGER, SQUAD_MANAGER
from fieldfit.operators.relational import distinct_keys, keep_in


def _viewer(members: DataFrame, viewer: str) -> DataFrame:
    return members.filter((F.col("email") == viewer) & F.col("active"))


def visible_owner_ids(members: DataFrame, grants: DataFrame, viewer: str) -> DataFrame:
    """Owner ids a viewer sees: own, delegated, and the squad of a squad manager."""
    me = _viewer(members, viewer)
    own = me.select("hubspot_owner_id")
    delegated = keep_in(
        members, grants.filter(F.col("grantee_email") == viewer).select(F.col("owner_email").alias("email")), "email"
    ).filter(me.agg(F.count(F.lit(1)) > 0).scalar())
    managed = me.filter(F.col("role") == SQUAD_MANAGER).select("squad")
    squad = keep_in(members, managed, "squad")
    ids = own.unionByName(delegated.select("hubspot_owner_id")).unionByName(squad.select("hubspot_owner_id"))
    return ids.filter(F.col("hubspot_owner_id").isNotNull()).distinct()


def visible_tickets(tickets: DataFrame, members: DataFrame, grants: DataFrame, viewer: str) -> DataFrame:
    """Tickets of the visible owners; a general manager sees every ticket.

    Two branches, of which the viewer's role empties one: an ordinary viewer's is
    a semi join with a few owner ids, a general manager's a plain scan.
    """
    ids = visible_owner_ids(members, grants, viewer).select(F.col("hubspot_owner_id").alias("owner_hubspot_id"))
    sees_all = _viewer(members, viewer).agg(F.count_if(F.col("role") == GENERAL_MANAGER) > 0).scalar()
    own = tickets.filter(~sees_all).join(ids, "owner_hubspot_id", "left_semi")
    return own.select(*tickets.columns).unionByName(tickets.filter(sees_all))


def visible_by(df: DataFrame, tickets: DataFrame, key: str) -> DataFrame:
    """Rows whose key (company, deal or ticket) belongs to a visible ticket."""
    return keep_in(df, tickets.filter(F.col(key).isNotNull()), key)


def visible_members(members: DataFrame, viewer: str) -> DataFrame:
    """All members for an active member, none for anyone else."""
    return members.filter(_viewer(members, viewer).agg(F.count(F.lit(1)) > 0).scalar())
