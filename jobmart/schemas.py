"""Row types of the stages."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_LIST = T.ArrayType(_S)

# --- fixed values: field names of an advert record -------------------------------------------
POSTING = T.StructType([
    T.StructField("job_id", _S),
    T.StructField("title", _S),
    T.StructField("company", _S),
    T.StructField("url", _S),
    T.StructField("salary", _S),
    T.StructField("location", _S),
    T.StructField("experience", _S),
    T.StructField("tags", _LIST),
    T.StructField("tags_requirement", _LIST),
    T.StructField("tags_specialization", _LIST),
    T.StructField("mo_ta_cong_viec_html", _S),
    T.StructField("yeu_cau_ung_vien_html", _S),
    T.StructField("quyen_loi_html", _S),
    T.StructField("deadline", _S),
])

MESSAGE = T.StructType([T.StructField("key", _S), T.StructField("value", _S)])

# A model's answer. Numbers arrive as text so that "5", 5 and 5.0 are all usable.
REPLY = T.StructType([
    T.StructField("domain", _S),
    T.StructField("technical_skills", _LIST),
    T.StructField("exp_max", _S),
    T.StructField("locations", _LIST),
    T.StructField("max_salary_verified", _S),
])
