"""Reconciliation runs: prepare both systems once, derive every result set, save the run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from revrecon.operators import actions, combined, commercial, identity, ledger, matching
from revrecon.session import settle
from revrecon.sinks.tables import save_result_sets

ACTION_LISTS = ("needs_attention", "outstanding_ar", "needs_posting", "mismatched")


def prepare_claims(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Claims with the patient id of the master."""
    return identity.claims_patient_match(claims, identity.patient_names(patients))


def billing_reconciliation(
    spark: SparkSession, visits: DataFrame, claims: DataFrame, patients: DataFrame, as_of: str | dt.date
) -> dict[str, DataFrame]:
    """The action lists, the operational summary and the overview."""
    known = settle(spark, prepare_claims(claims, patients), "claims_with_patient")
    last = actions.claims_last_by_key(known)
    flagged = settle(spark, actions.action_flags(visits, last, as_of), "action_flags")
    results = {
        "operational": actions.operational_summary(visits),
        "overview": actions.reconciliation_overview(flagged, visits, claims),
    }
    results.update({name: flagged.filter(name) for name in ACTION_LISTS})
    return results


def comparison(spark: SparkSession, visits: DataFrame, claims: DataFrame, patients: DataFrame) -> dict[str, DataFrame]:
    """Matched, one-sided and master tables of the two systems."""
    known = settle(spark, prepare_claims(claims, patients), "claims_with_patient")
    return {
        "comparison_matched": matching.compare_matched(visits, known),
        "visits_only": matching.visits_only(visits, known),
        "claims_only": matching.claims_only(visits, known),
        "billing_master": matching.billing_master(visits, known),
    }


def ledger_reconciliation(
    spark: SparkSession,
    visits: DataFrame,
    claims: DataFrame,
    patients: DataFrame,
    deposits: DataFrame,
    pl: DataFrame,
    facility_map: Mapping[str, str],
    office_facility: Callable[[str], Column],
) -> dict[str, DataFrame]:
    """Month-level tables against deposits and against the P&L.

    ``facility_map`` shortens facility names, ``office_facility`` gives the facility of an office column.
    """
    known = prepare_claims(claims, patients)
    merged = settle(spark, combined.combined_dedup(visits, known, office_facility), "combined")
    kept = ledger.patient_deposits(ledger.deposits_dedup(deposits))
    by_deposit = ledger.recon_deposits_monthly(visits, kept, facility_map)
    by_pl = ledger.recon_pl_monthly(merged, pl, facility_map)
    return {
        "combined": merged,
        "deposits": kept,
        "recon_deposits_monthly": by_deposit,
        "recon_deposits_flags": ledger.recon_flags(by_deposit, ledger.DEPOSIT_RULE),
        "recon_pl_monthly": by_pl,
        "recon_pl_flags": ledger.recon_flags(by_pl, ledger.LEDGER_RULE),
    }


def commercial_audit(
    spark: SparkSession, visits: DataFrame, claims: DataFrame, patients: DataFrame
) -> dict[str, DataFrame]:
    """Detail, overview and roll-ups of the commercial audit."""
    last = settle(spark, actions.claims_last_by_key(prepare_claims(claims, patients)), "claims_last")
    names = identity.id_to_name(patients)
    return {
        "commercial_audit": commercial.commercial_detail(visits, last, names, ordered=False),
        "commercial_overview": commercial.commercial_overview(visits, last),
        "commercial_rollups": commercial.commercial_rollups(visits, last),
    }


def save_run(results: dict[str, DataFrame], folder: str, stamp: str) -> dict[str, str]:
    """Every result set of a run; empty action lists are not saved."""
    return save_result_sets(results, folder, stamp, skip_empty=ACTION_LISTS)
