"""Master-data view: every loan row kept, null ids bypass the id join."""

from pyspark.sql import functions as F

from loanscore.operators import mdm


def test_mdm_keeps_every_loan_and_null_ids(keyed_smoke):
    # make some ids non-numeric: they cast to null and can match no payment
    k = keyed_smoke.withColumn("id", F.when(F.col("id").try_cast("long") % 7 == 0, F.lit("x")).otherwise(F.col("id")))
    view = mdm.mdm_view(k, 256)
    kept = k.where("member_id != sha2('', 256)").count()
    assert view.count() == kept
    nulls = view.where("id IS NULL")
    assert nulls.count() > 0
    assert nulls.where("total_pymnt IS NOT NULL OR installment IS NOT NULL").count() == 0
    # rows with an id carry their own payment record
    assert view.where("id IS NOT NULL AND total_pymnt IS NULL").count() == 0
    assert view.columns == list(mdm.MDM_COLUMNS)
    assert view.where("member_id IS NULL").count() == 0


def test_member_profile_is_one_aggregate(keyed_smoke):
    prof = mdm.member_profile(keyed_smoke, 256)
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_key") == 1
    assert prof.count() == prof.select("member_id").distinct().count()


def test_sql_view_form_equals_dataframe_form(spark, keyed_smoke):
    from loanscore.operators import defaults, inquiries, loan, payment, personal
    from loanscore.operators.common import unstamped

    k = keyed_smoke
    mdm.register_subject_views(
        unstamped(loan.clean(loan.details(k), 256)),
        unstamped(personal.clean(personal.details(k), 256)),
        unstamped(payment.clean(payment.details(k), 256)),
        unstamped(defaults.clean(defaults.details(k), 256)),
        unstamped(inquiries.clean(inquiries.details(k), 256)),
    )
    view = mdm.create_mdm_sql_view(spark)
    frame = mdm.mdm_view(k, 256)
    assert view.columns == frame.columns
    assert view.exceptAll(frame).count() == 0 and frame.exceptAll(view).count() == 0


def test_subjects_from_profile_equal_subject_pipelines(keyed_smoke):
    from loanscore.operators import defaults, inquiries, personal
    from loanscore.operators.common import unstamped

    derived = mdm.subjects_from_profile(mdm.member_profile(keyed_smoke, 256))
    for name, mod in (("personal", personal), ("defaults", defaults), ("inquiries", inquiries)):
        direct = unstamped(mod.clean(mod.details(keyed_smoke), 256))
        assert derived[name].columns == direct.columns
        assert derived[name].dtypes == direct.dtypes
        assert derived[name].exceptAll(direct).count() == 0 and direct.exceptAll(derived[name]).count() == 0
