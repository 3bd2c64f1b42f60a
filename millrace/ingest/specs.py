"""What each warehouse table takes from its source."""

from __future__ import annotations

from dataclasses import dataclass, field

STAMP_COLUMNS = ["cust_no", "isvalid", "src_fields_md5", "createts", "updatets"]


def labelled(prefix: str, places: int) -> str:
    """The usual fingerprint template: ``P.%s|P.%s|...``."""
    return "|".join([f"{prefix}.%s"] * places)


@dataclass(frozen=True)
class IngestSpec:
    """One table: business columns, change-time column (``None`` = full refresh), fingerprint template."""

    target: str
    columns: list[str]
    changed: str | None
    template: str
    key: str = "id"
    cust_no: str = "1"
    isvalid: str = "1"
    source: str = field(default="")

    @property
    def hashed(self) -> list[str]:
        return self.columns + ([self.changed] if self.changed else [])

    @property
    def layout(self) -> list[str]:
        return self.columns + STAMP_COLUMNS


def _spec(target: str, columns: str, changed: str | None, template: str, key: str = "id") -> IngestSpec:
    return IngestSpec(target, columns.split(), changed, template, key)


# Column lists, change-time columns and fingerprint templates of the warehouse. Stored
# fingerprints depend on every character of a template, so the four irregular ones stay irregular.
WAREHOUSE = {
    spec.target: spec
    for spec in [
        _spec(
            "ets_apply_student",
            "id place_id learn_id std_id start_dt end_dt status type",
            "updated_at",
            # no separator between the fourth and the fifth part
            labelled("Apply_Student", 4) + labelled("Apply_Student", 5),
        ),
        _spec("ets_gradeitem", "id learn_id learn_type scoresheetcode", None, labelled("GradeItem", 4)),
        _spec("ets_learn", "id name status type scoresheetcode", "updated_at", labelled("Learn", 6)),
        _spec(
            "ets_osce_das_admin_report", "adminid examid report", "creattime", labelled("osce_das_admin_report", 4), "adminid"
        ),
        _spec(
            "ets_osce_das_examiner_report",
            "examerid examid report",
            "creattime",
            labelled("osce_das_examiner_report", 4),
            "examerid",
        ),
        _spec(
            "ets_osce_das_student_report", "stuid examid report", "creattime", labelled("osce_das_student_report", 4), "stuid"
        ),
        _spec("ets_osce_exam", "id name begintime endtime examtype", "updatetime", labelled("osce_exam", 6)),
        # the prefix is another table's name
        _spec("ets_osce_exam_examinee", "id examineeid examid", None, labelled("GradeItem", 3)),
        _spec(
            "ets_osce_score",
            "id examineeid examid roomid stationid examinerid totalscore begintime endtime scoresheetcode status",
            "updatetime",
            # a blank before the last separator
            labelled("osce_score", 11) + " |osce_score.%s",
        ),
        _spec("ets_osce_station", "id name duration", "updatetime", labelled("osce_station", 4)),
        _spec("ets_questionsend", "id qid schedule_id sg_id type", "updated_at", labelled("QuestionSend", 6)),
        _spec("ets_questionvoterecord", "id userid vote_id", "created_at", labelled("QuestionVoteRecord", 4)),
        _spec(
            "ets_schedule",
            "id course_id start_dt start_time end_time std_total place_id status",
            "updated_at",
            labelled("Schedule", 9),
        ),
        _spec("ets_schedule_std", "id schedule_id std_id", "updated_at", labelled("Schedule_Std", 4)),
        _spec("ets_schedule_teacher", "id schedule_id teacher_id", "updated_at", labelled("Schedule_Teacher", 4)),
        _spec(
            "ets_score",
            "id starttime endtime operatorstudentid graderstudentid scoresheetcode totalscore",
            "updatetime",
            # the first prefix is lower-case
            "score.%s|" + labelled("Score", 7),
        ),
        _spec("ets_tasks", "id schedule_id", "updated_at", labelled("Tasks", 3)),
    ]
}
