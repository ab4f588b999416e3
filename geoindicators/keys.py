"""Key columns of an indicator fact row.

A fact row carries a year, a district (id, name), an optional sub-district
(id, name) and any number of numeric measures.  The level of a row is encoded
in the keys:

* sub-district: ``sub_id`` is not null
* district:     ``sub_id`` is null and ``district_id`` is not the city id
* city:         ``district_id`` equals the city id
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Keys:
    date: str = "date"
    district_id: str = "district_id"
    district_name: str = "district_name"
    sub_id: str = "sub_id"
    sub_name: str = "sub_name"
    city_id: str = "00"
    city_name: str = "Oslo i alt"
    # districts that are published in no document of their own and are left
    # out of scales and relative ratios
    non_residential: tuple[str, ...] = ("16", "17", "99")

    def all(self) -> list[str]:
        return [self.date, self.district_id, self.district_name, self.sub_id, self.sub_name]

    def district_level(self) -> list[str]:
        return [self.date, self.district_id, self.district_name]

    def geo(self) -> list[str]:
        return [self.district_id, self.district_name, self.sub_id, self.sub_name]

    def with_non_residential(self, ids) -> "Keys":
        return Keys(self.date, self.district_id, self.district_name, self.sub_id,
                    self.sub_name, self.city_id, self.city_name, tuple(ids))


# Column names of the published Oslo documents (fixed values).
OSLO_KEYS = Keys(
    date="date",
    district_id="bydel_id",
    district_name="bydel_navn",
    sub_id="delbydel_id",
    sub_name="delbydel_navn",
    city_id="00",
    city_name="Oslo i alt",
    non_residential=("16", "17", "99"),
)
