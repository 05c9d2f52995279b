"""Clean stage: raw adverts to typed columns, as projections over one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmart.functions.experience import with_clean_experience
from jobmart.functions.fields import (has_content, it_verdict, with_deadline,
                                      with_requirement_tags)
from jobmart.functions.salary import with_clean_salary
from jobmart.functions.text import html_to_text, strip_location_marker

TEXTS = {
    "mo_ta_text": "mo_ta_cong_viec_html",
    "yeu_cau_text": "yeu_cau_ung_vien_html",
    "quyen_loi_text": "quyen_loi_html",
}
COLUMNS = [
    "job_id", "title", "company", "url", "tags", "tags_specialization", *TEXTS, "has_content",
    "salary_raw", "min_salary", "max_salary", "salary_currency", "salary_type", "exp_min",
    "exp_type", "deadline_date", "location_raw", "edu_level", "gender", "age_min", "age_max",
    "req_languages", "is_it_preliminary",
]


def clean(postings: DataFrame) -> DataFrame:
    """Typed view of the adverts that carry a ``job_id``. No shuffle, no Python."""
    return (
        postings.filter(F.col("job_id").isNotNull())
        .withColumns({name: html_to_text(F.col(source)) for name, source in TEXTS.items()})
        .transform(with_clean_salary)
        .transform(with_clean_experience)
        .transform(with_deadline)
        .transform(with_requirement_tags)
        .withColumns({
            "has_content": has_content(F.col("mo_ta_text"), F.col("yeu_cau_text")),
            "salary_raw": F.col("salary"),
            "location_raw": strip_location_marker(F.col("location")),
            "is_it_preliminary": it_verdict(F.col("tags_specialization"))})
        .select(*COLUMNS))
