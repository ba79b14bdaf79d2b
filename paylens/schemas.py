"""Explicit schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, L, BYTES = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.BinaryType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dt", T.DateType())])


RANGE_PAY = struct(min=D, max=D, currency=S, interval=S)
TIER_PART = struct(compensationType=S, interval=S, currencyCode=S, minValue=D, maxValue=D)
TIER_PAY = struct(compensationTierSummary=S, scrapeableCompensationSalarySummary=S,
                  compensationTiers=T.ArrayType(struct(components=T.ArrayType(TIER_PART))))

# Landed board dumps. ``source`` and ``company`` are directory names, kept as text.
BOARD = struct(source=S, company=S)
GREENHOUSE = struct(jobs=T.ArrayType(struct(
    id=L, title=S, location=struct(name=S), content=S, first_published=S, updated_at=S, absolute_url=S,
    departments=T.ArrayType(struct(id=L, name=S)))))
LEVER = struct(
    id=S, text=S, categories=struct(commitment=S, department=S, location=S, team=S), createdAt=L, descriptionPlain=S,
    salaryRange=RANGE_PAY, country=S, workplaceType=S, hostedUrl=S)
ASHBY = struct(jobs=T.ArrayType(struct(
    id=S, title=S, department=S, employmentType=S, location=S, publishedAt=S, isRemote=B, jobUrl=S,
    descriptionPlain=S, compensation=TIER_PAY)))

# Place of a posting in the landing: file, block and line of the document in it, place in the document. Compares in
# ingest order, and no two postings share it.
ORIGIN = struct(file=S, block=L, line=L, place=L)
POSTING = struct(
    source=S, company=S, job_id=S, title=S, location_raw=S, is_remote=B, employment_type=S, published_at_raw=S,
    published_at=T.TimestampType(), apply_url=S, department=S, description=S, tier_pay=TIER_PAY, range_pay=RANGE_PAY,
    country=S, ingest_seq=ORIGIN)

SNAPSHOTS = struct(
    job_uid=S, snapshot_date=T.DateType(), source=S, company=S, region=S, is_remote=B, seniority=S, is_management=B,
    salary_min_usd=D, salary_max_usd=D, salary_mid_usd=D, has_salary=B, employment_type=S,
    published_at=T.TimestampType())
JOBS = struct(
    job_uid=S, first_seen=T.DateType(), source=S, company=S, title=S, location_raw=S, region=S, is_remote=B,
    seniority=S, is_management=B, employment_type=S, published_at=T.TimestampType(), apply_url=S, currency_original=S,
    salary_min_orig=D, salary_max_orig=D, salary_interval_orig=S, salary_min_usd=D, salary_max_usd=D,
    salary_mid_usd=D, has_salary=B)
SKILLS = struct(job_uid=S, skill=S, source=S, prompt_version=S, extracted_at=T.TimestampType())
KEYS = struct(slots=L, slot=L, bits=BYTES)  # filters over the keys of a day
COUNTS = struct(source=S, n=L)  # rows of a day by source; a row of NULLs says that the day must be counted again
TABLES = {"snapshots": SNAPSHOTS, "jobs": JOBS, "skills": SKILLS, "jobs_keys": KEYS, "snapshots_keys": KEYS,
          "counts": COUNTS}

GOLD = struct(id=L, title=S, text=S, expected=T.ArrayType(S))
REGISTRY = struct(name=S, ats=S, source=S, slug=S, status=S, added=S, n_jobs=L, has_eu=B, has_remote=B)
PRIMARY_RATES = struct(result=S, rates=T.MapType(S, D))
SECONDARY_RATES = struct(usd=T.MapType(S, D))
