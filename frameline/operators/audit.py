"""API audit, event routing and rule compliance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Policy events that raise an alarm.
POLICY_EVENTS = (
    "CreatePolicy", "DeletePolicy", "CreatePolicyVersion", "DeletePolicyVersion", "AttachRolePolicy", "DetachRolePolicy",
    "AttachUserPolicy", "DetachUserPolicy", "AttachGroupPolicy", "DetachGroupPolicy",
)
FUNCTION_SOURCE = "aws.lambda"
SUCCESS_DETAIL = "Lambda Function Invocation Result - Success"
FAILURE_DETAIL = "Lambda Function Invocation Result - Failure"


def audit_predicates() -> dict[str, Column]:
    code = F.col("error_code")
    hits = {
        "unauthorized": code.endswith("UnauthorizedOperation") | code.startswith("AccessDenied"),
        "root_use": (F.col("user_type") == "Root") & F.col("invoked_by").isNull() & (F.col("event_kind") != "AwsServiceEvent"),
        "policy_change": F.col("event_name").isin(*POLICY_EVENTS),
    }
    return {name: F.coalesce(hit, F.lit(False)) for name, hit in hits.items()}


def classify_audit(events: DataFrame) -> DataFrame:
    return events.select(*events.columns, *[hit.alias(name) for name, hit in audit_predicates().items()])


def audit_hits(events: DataFrame) -> DataFrame:
    """One row per event and predicate it meets (works on streams)."""
    names = F.array(*[F.when(hit, name) for name, hit in audit_predicates().items()])
    return events.select("*", F.explode(F.array_compact(names)).alias("finding"))


def route_events(events: DataFrame, completion_functions: Sequence[str], pipeline_functions: Sequence[str]) -> DataFrame:
    """One row per event and route: success of a completion function, failure of a pipeline function."""
    source = F.col("source") == FUNCTION_SOURCE
    done = source & (F.col("detail_type") == SUCCESS_DETAIL) & F.col("function_name").isin(*completion_functions)
    failed = source & (F.col("detail_type") == FAILURE_DETAIL) & F.col("function_name").isin(*pipeline_functions)
    routes = F.array_compact(F.array(F.when(done, "pipeline_completion"), F.when(failed, "pipeline_failure")))
    return events.select("*", F.explode(routes).alias("route"))


def _counted(evaluations: DataFrame) -> DataFrame:
    return evaluations.filter(F.col("compliance_type").isin("COMPLIANT", "NON_COMPLIANT"))


def compliance_by_rule(evaluations: DataFrame) -> DataFrame:
    """Counts per rule; a rule with neither result keeps a row with zeros. See :func:`non_compliant_details`."""
    kind = F.col("compliance_type")
    return evaluations.groupBy("rule_name").agg(
        F.count_if(kind == "COMPLIANT").alias("compliant"), F.count_if(kind == "NON_COMPLIANT").alias("non_compliant")
    )


def non_compliant_details(evaluations: DataFrame) -> DataFrame:
    """The offending resources as rows, not as one list per rule."""
    return evaluations.filter(F.col("compliance_type") == "NON_COMPLIANT").select("rule_name", "resource_id", "resource_type")


def compliance_overall(evaluations: DataFrame) -> DataFrame:
    """Percentage of compliant results, 100 when nothing was evaluated."""
    totals = _counted(evaluations).agg(F.count(F.lit(1)).alias("evaluated"), F.count_if(F.col("compliance_type") == "COMPLIANT").alias("compliant"))
    percent = F.when(F.col("evaluated") == 0, F.lit(100.0)).otherwise(F.round(F.col("compliant") / F.col("evaluated") * 100, 4))
    return totals.withColumn("percent", percent)
