"""Roles, departments and lead types from names, titles and addresses, by ordered rules."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from dirlens.functions import text, words


RESULT = "struct<role:string,department:string,type:string>"
#: A rule: any of keys and, if there are further ones, any of these.
RULES = f"array<struct<keys:array<string>,further:array<string>,result:{RESULT}>>"


def _role(role: Column | str, department: str, kind: str) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), F.lit(department).alias("department"), F.lit(kind).alias("type"))


def _rule(keys: tuple[str, ...], further: tuple[str, ...], role: str, department: str, kind: str) -> dict:
    return {"keys": keys, "further": further, "result": {"role": role, "department": department, "type": kind}}


def _subject_rules(keys: tuple[str, ...] = ()) -> list[dict]:
    """A rule for each subject, under keys if given."""
    return [_rule(keys or (k,), (k,) if keys else (), role, department, words.TEACHER) for k, role, department in words.SUBJECTS]


def _title_rules() -> list[dict]:
    out = []
    for keys, further, role, department, kind in words.TITLE_RULES:
        if role is None:  # the subject's, or what stands in the next two places
            out += [*_subject_rules(keys), _rule(keys, further, department, kind, words.TEACHER)]
        else:
            out.append(_rule(keys, further, role, department, kind))
    return out


def _address_rules() -> list[dict]:
    *rules, (last_keys, *last) = words.ADDRESS_RULES
    return [*[_rule(keys, (), *rest) for keys, *rest in rules], *_subject_rules(), _rule(last_keys, (), *last)]


def first_rule(c: Column, rules: list[dict]) -> Column:
    """The result of the first rule that c meets, or null. The rules are one literal, so plans stay small."""
    table = F.from_json(F.lit(json.dumps(rules)), RULES)

    def meets(r: Column) -> Column:
        return F.exists(r["keys"], lambda k: F.contains(c, k)) & ((F.size(r["further"]) == 0) | F.exists(r["further"], lambda k: F.contains(c, k)))

    return F.get(F.filter(table, meets), F.lit(0))["result"]


def subject(c: Column) -> Column:
    """The struct of the first subject keyword contained in c, or null."""
    return first_rule(c, _subject_rules())


def infer_role(name: Column, title: Column, email: Column, directory_url: Column, school: Column) -> Column:
    """struct(role, department, type): credentials in the name, then title, school, address, fallback."""

    def lower(c: Column) -> Column:
        return F.lower(F.coalesce(c, F.lit("")))

    shown = text.clean(title)
    inputs = F.struct(F.upper(text.clean(name)).alias("name"), shown.alias("title"), F.lower(shown).alias("low"), lower(email).alias("email"), lower(directory_url).alias("address"), lower(school).alias("place"))
    return text.let(inputs, _infer)


def _infer(x: Column) -> Column:
    shown, low, place = x["title"], x["low"], x["place"]
    by_name = [(F.rlike(x["name"], F.lit(rf"(?:,\s*|\s){key}\b")), _role(role, "Health Services", words.HEALTH)) for key, role in words.NURSES]
    by_title = F.coalesce(first_rule(low, _title_rules()), _role(shown, "General Staff", words.OTHER))
    fallback = F.when(F.contains(x["email"], F.lit("@")), _role("District Employee", "General Staff", words.OTHER)).otherwise(_role("Staff", "General Staff", words.OTHER))
    professions = F.contains(place, F.lit("health")) & F.contains(place, F.lit("profession"))
    cases = [*by_name, (~low.isin(*words.NO_TITLE), by_title), (professions, _role("Health Professions Staff", "Health Services", words.HEALTH))]
    return text.first_hit(cases, F.coalesce(first_rule(x["address"], _address_rules()), fallback))


def is_district_scope(district: Column, school: Column) -> Column:
    place, whole = F.lower(F.trim(F.coalesce(school, F.lit("")))), F.lower(F.trim(F.coalesce(district, F.lit(""))))
    return (place == "") | ((whole != "") & (place == whole)) | text.any_of(place, words.DISTRICT_SCOPE)


def lead_type(title: Column, role: Column, kind: Column, district: Column, school: Column) -> Column:
    """Dist, School, Teacher or Other."""
    both = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(role, F.lit(""))))
    scoped = F.when(is_district_scope(district, school), "Dist").otherwise("School")

    def decide(x: Column) -> Column:
        coach = F.contains(x, F.lit("coach")) & ~F.contains(x, F.lit("director"))
        cases = [
            (F.contains(x, F.lit("superintendent")) | text.any_of(x, words.LEAD_BOARD) | F.rlike(x, F.lit(r"\bdistrict\b")), F.lit("Dist")),
            (text.any_of(x, words.LEAD_SCHOOL), F.lit("School")),
            ((F.coalesce(kind, F.lit("")) == words.TEACHER) | text.any_of(x, words.LEAD_TEACHER), F.lit("Teacher")),
            (text.any_of(x, words.LEAD_ADMIN), F.when(coach, "Other").otherwise(scoped)),
        ]
        return text.first_hit(cases, F.lit("Other"))

    return text.let(both, decide)


def foxbright_lead(role: Column, building: Column) -> Column:
    named = (building != "") & ~F.contains(F.lower(building), F.lit("administ"))
    return F.when(F.contains(F.lower(F.coalesce(role, F.lit(""))), F.lit("teacher")), "Teacher").when(named, "School").otherwise("Dist")


# The same rules as SQL text, for comparison in another engine.


def infer_role_sql(title: str, part: int) -> str:
    """The role (0), department (1) or type (2) that a title gives, for titles that are not generic."""

    def literal(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    cases = []
    for keys, further, role, department, kind in words.TITLE_RULES:
        hit = text.any_of_sql(f"lower({title})", keys)
        if role is None:
            cases += [(f"{hit} AND contains(lower({title}), {literal(k)})", literal((r, d, words.TEACHER)[part])) for k, r, d in words.SUBJECTS]
            role, department, kind = department, kind, words.TEACHER
        cases.append((f"{hit} AND {text.any_of_sql(f'lower({title})', further)}" if further else hit, literal((role, department, kind)[part])))
    return text.first_hit_sql(cases, (title, "'General Staff'", "'other'")[part])


def lead_type_sql(title: str, role: str, kind: str, district: str, school: str) -> str:
    both = f"lower({title} || ' ' || {role})"
    scope = f"(coalesce({school}, '') = '' OR lower({school}) = lower({district}) OR {text.any_of_sql(f'lower({school})', words.DISTRICT_SCOPE)})"
    return text.first_hit_sql(
        [
            (f"contains({both}, 'superintendent') OR {text.any_of_sql(both, words.LEAD_BOARD)} OR regexp_matches({both}, '\\bdistrict\\b')", "'Dist'"),
            (text.any_of_sql(both, words.LEAD_SCHOOL), "'School'"),
            (f"{kind} = 'teacher' OR {text.any_of_sql(both, words.LEAD_TEACHER)}", "'Teacher'"),
            (f"{text.any_of_sql(both, words.LEAD_ADMIN)} AND contains({both}, 'coach') AND NOT contains({both}, 'director')", "'Other'"),
            (f"{text.any_of_sql(both, words.LEAD_ADMIN)} AND {scope}", "'Dist'"),
            (text.any_of_sql(both, words.LEAD_ADMIN), "'School'"),
        ],
        "'Other'",
    )
