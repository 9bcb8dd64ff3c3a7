"""loanscore: member scoring for consumer-loan applications on Spark.

Typical use::

    from loanscore import read_applications_csv, with_member_key, member_scores
    raw = read_applications_csv(spark, "applications.csv")
    scores = member_scores(with_member_key(raw))          # one shuffle

or the whole job (five cleaned subjects plus points)::

    from loanscore import run_job
    run_job(spark, raw, "out/cleaned_data", "out/points_data")
"""

from loanscore.functions.keys import drop_empty_profiles, member_key, with_member_key
from loanscore.levels import DEFAULT_LEVELS, DEFAULT_WEIGHTS, Levels, Weights
from loanscore.operators import defaults, inquiries, loan, payment, personal, quality
from loanscore.operators.combine import final_points, final_points_joined, member_scores
from loanscore.operators.mdm import (
    create_mdm_sql_view,
    mdm_view,
    member_profile,
    register_subject_views,
    subjects_from_profile,
)
from loanscore.plans.job import run as run_job
from loanscore.sources.csv import read_applications_csv
from loanscore.sources.sinks import save_points, save_subject

__all__ = [
    "DEFAULT_LEVELS",
    "DEFAULT_WEIGHTS",
    "Levels",
    "Weights",
    "create_mdm_sql_view",
    "defaults",
    "drop_empty_profiles",
    "final_points",
    "final_points_joined",
    "inquiries",
    "loan",
    "mdm_view",
    "member_key",
    "member_profile",
    "member_scores",
    "payment",
    "personal",
    "quality",
    "read_applications_csv",
    "register_subject_views",
    "run_job",
    "save_points",
    "save_subject",
    "subjects_from_profile",
    "with_member_key",
]
