"""Rules that turn a source's categories to groups, kinds of trade and land prices, as data.

Groups: 1 houses, 2 flats, 3 land, 4 rent; 5 is the land price.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrane.functions.text import words_only

LARGEST_PRICE_M2 = 9_999_999_999_999_999


@dataclass(frozen=True)
class Groups:
    """Categories of groups 1 to 3. `fold`: compare by `words_only`. `any_trade`: also for trades other than sale."""

    houses: tuple[str, ...]
    flats: tuple[str, ...]
    land: tuple[str, ...]
    rent: tuple[str, ...] = ("u",)
    fold: bool = False
    any_trade: bool = False
    #: Categories that stay without a group, where all others that are sold belong to group 4.
    others: tuple[str, ...] | None = None

    def of(self, category: Column, trade: Column) -> Column:
        c = words_only(category) if self.fold else category
        group = F.when(c.isin(*self.houses), 1).when(c.isin(*self.flats), 2).when(c.isin(*self.land), 3)
        if self.others is not None:
            group = group.when(c.isNotNull() & ~c.isin(*self.others), 4)
        group = group if self.any_trade else F.when(trade == "s", group)
        return F.when(trade.isin(*self.rent), 4).otherwise(group)


#: Categories by the way in which a source names them.
GROUPS = {
    "numbers": Groups(("1", "2", "3"), ("5", "56"), ("8", "10", "11")),
    "codes": Groups(("1020",), ("1010",), ("1040",)),
    "codes_all": Groups(("1020",), ("1010",), ("1040",), rent=("u", "r"), others=("1030",)),
    "plain": Groups(("Nhà riêng",), ("Căn hộ chung cư",), ("Đất", "Kho, nhà xưởng")),
    "names": Groups(
        ("Nhà hẻm ngõ", "Nhà mặt tiền phố", "Nhà biệt thự, liền kề", "Đường nội bộ"),
        ("Căn hộ chung cư", "Căn hộ dịch vụ", "Căn hộ tập thể, cư xá", "Căn hộ Penthouse", "Căn hộ Officetel"),
        ("Đất thổ cư", "Đất nền dự án", "Đất nông nghiệp", "Đất kho xưởng"),
    ),
    "folded": Groups(
        ("nha rieng", "nha mat pho", "biet thu lien ke", "duong noi bo", "nha biet thu lien ke", "nha hem ngo", "nha mat tien pho"),
        ("can ho chung cu mini", "condotel", "can ho chung cu", "can ho dich vu", "can ho officetel", "can ho penthouse", "can ho tap the cu xa"),
        ("dat", "kho nha xuong dat", "dat kho xuong", "dat nen du an", "dat nong nghiep", "dat tho cu"),
        fold=True,
    ),
    "ids": Groups(
        ("62", "63", "66", "56", "172", "170", "171", "190", "81", "174", "85"),
        ("57", "73", "70", "71", "164", "165", "166", "167", "68", "168", "169", "76"),
        ("58", "78", "77", "79", "83", "80", "87"),
        rent=("u", "r"),
        any_trade=True,
    ),
    "slugs": Groups(
        ("nha_tap_the", "khu_nghi_duong_resort", "nha_rieng", "nha_tro", "biet_thu_lien_ke", "khach_san_nha_nghi", "van_phong", "shophouse_nha_pho_thuong_mai", "nha_mat_pho"),
        ("can_ho_van_phong_officetel", "chung_cu_mini", "can_ho_khach_san_condotel", "can_ho_chung_cu", "can_ho_dich_vu_homestay"),
        ("trang_trai", "dat", "kho_nha_xuong", "dat_nen_du_an"),
    ),
    "phrases": Groups(
        ("Nhà mặt tiền", "Nhà trong hẻm", "Biệt thự, nhà liền kề"),
        ("Căn hộ chung cư", "Shop, kiot, quán"),
        ("Mặt bằng", "Đất thổ cư, đất ở", "Đất nền, liền kề, đất dự án", "Đất nông, lâm nghiệp", "Trang trại"),
    ),
}


def trade_kind(x: Column) -> Column:
    """s for sale, u for rent, from letters or words; null if neither."""
    t = F.lower(x)
    sale = t.isin("s", "mua") | t.contains("ban") | t.contains("bán")
    rent = t.contains("thue") | t.contains("thuê")
    return F.when(t == "s", "s").when(t == "u", "u").when(sale, "s").when(rent, "u")


def trade_kind_of_url(url: Column) -> Column:
    return F.when(url.contains("/ban-"), "s").when(url.contains("/cho-thue-"), "u")


def trade_kind_of_number(x: Column) -> Column:
    return F.when(x.isin(1, 2), "s").when(x == 3, "u")


@dataclass(frozen=True)
class LandPrice:
    """Shares of the price that count as land, by category; `cut`: truncate instead of rounding half to even."""

    shares: dict[str, float] = field(default_factory=dict)
    cut: bool = False

    def of(self, category: Column, trade: Column, price: Column) -> Column:
        """Struct (price_land, status): DONE with a price, or SKIP."""
        c = F.regexp_replace(F.trim(category), r"[ .]+$", "")
        value = None
        for share in sorted(set(self.shares.values()), reverse=True):
            names = [n for n, s in self.shares.items() if s == share]
            product = price.cast("double") * share
            whole = price.cast("long") if share == 1 else (product.cast("long") if self.cut else F.bround(product, 0).cast("long"))
            value = F.when(c.isin(*names), whole) if value is None else value.when(c.isin(*names), whole)
        value = F.when((trade == "s") & (price > 0), value)
        return F.struct(value.alias("price_land"), F.when(value.isNotNull(), "DONE").otherwise("SKIP").alias("status"))


#: 1 east, 2 west, 3 south, 4 north, 5 north-east, 6 south-east, 7 north-west, 8 south-west.
DIRECTIONS = 8


def direction_code(x: Column) -> Column:
    """The whole part of a number if it is a direction's, else null."""
    number = F.trim(x).try_cast("double")
    code = F.when(F.abs(number) < 1000, number.cast("int"))
    return F.when(code.between(1, DIRECTIONS), code)


def _shares(land: tuple[str, ...], houses: tuple[str, ...], share: float = 0.85) -> dict[str, float]:
    return dict.fromkeys(land, 1.0) | dict.fromkeys(houses, share)


#: Fixed values.
LAND_PRICES = {
    "plain": LandPrice(_shares(("Đất",), ("Nhà riêng", "Kho, nhà xưởng")), cut=True),
    "numbers": LandPrice(_shares(("8", "10", "11", "57"), ("1", "2", "3", "13", "14"))),
    "codes": LandPrice(_shares(("1040",), ("1020",))),
    "ids": LandPrice(_shares(("58", "79"), ("56", "62", "63", "66"))),
    "names": LandPrice(
        _shares(("Đất thổ cư", "Đất nền dự án", "Đất nông nghiệp", "Đất kho xưởng"), ("Nhà mặt tiền phố", "Nhà hẻm ngõ", "Nhà biệt thự, liền kề", "Đường nội bộ", "Nhà xưởng, kho bãi"))
    ),
    "folded": LandPrice(
        _shares(("Đất", "Đất nền dự án"), ("Nhà riêng", "Nhà mặt phố", "Biệt thự liền kề", "Kho, nhà xưởng, đất", "Kho, nhà xưởng", "Shophouse", "Trang trại/Khu nghỉ dưỡng"))
    ),
    "slugs": LandPrice(
        _shares(("dat_tho_cu", "dat_nen_du_an"), ("nha_rieng", "nha_mat_pho", "biet_thu_lien_ke", "kho_xuong_ben_bai", "shophouse", "trang_trai_khu_nghi_duong"))
    ),
    "phrases": LandPrice(
        _shares(("Đất thổ cư, đất ở", "Đất nền, liền kề, đất dự án", "Đất nông, lâm nghiệp"), ("Kho, xưởng", "Trang trại"))
        | {"Nhà mặt tiền": 0.75, "Nhà trong hẻm": 0.75, "Biệt thự, nhà liền kề": 0.65},
        cut=True,
    ),
}


def price_m2(price: Column, area: Column, whole: bool = False) -> Column:
    """Price by area; null unless both are positive. `whole`: cut to a whole number."""
    value = F.when((price > 0) & (area > 0), price / area)
    return value.cast("long") if whole else value


def price_m2_by_unit(price: Column, area: Column, unit: Column, least_total: int = 500_000_000) -> Column:
    """By unit: of prices for m2, those below `least_total` are taken as prices of one square metre."""
    by_area = F.when((price > 0) & (area > 0), price / area)
    value = F.when((unit == "m2") & (price > 0), F.when(price < least_total, price.cast("double")).otherwise(by_area)).when(unit.isin("md", "thang"), by_area)
    return F.when(value <= LARGEST_PRICE_M2, value)


def price_m2_if_plausible(price: Column, area: Column, unit: Column, least_total: int, least_m2: int) -> Column:
    """The price of a square metre, cut to a whole number, where the unit is m2, the price at least `least_total`, the area
    a plain positive number and the result at least `least_m2`; else the price as it is. `area` is a text."""
    size = F.when(area.rlike(r"^[0-9]+([.,][0-9]+)?$"), F.round(F.replace(area, F.lit(","), F.lit(".")).try_cast("decimal(28,8)"), 4).cast("double"))
    value = F.when((unit == "m2") & (price >= least_total) & (size > 0), price / size)
    return F.when(value >= least_m2, value.cast("long")).otherwise(price)


#: What a kind of home is called when it is sold or let, and its number there; the first phrase that the
#: category holds wins.
SALE_TYPES = (
    (("Nhà riêng", "Nhà hẻm"), 2), (("Nhà phố", "Mặt tiền", "Đường nội bộ"), 1), (("Biệt thự",), 3), (("Chung cư", "Tập thể", "Penthouse", "Officetel"), 5),
    (("Mini", "Căn hộ dịch vụ"), 56), (("Khách sạn", "Nhà hàng"), 13), (("Kho", "Xưởng", "Đất kho xưởng"), 14), (("Đất nền",), 8), (("Đất thổ cư",), 11),
    (("Nông nghiệp", "Lâm nghiệp"), 10),
)
RENT_TYPES = (
    (("Nhà phố", "Mặt tiền"), 1), (("Nhà riêng", "Nhà hẻm"), 2), (("Biệt thự",), 3), (("Chung cư", "Tập thể", "Penthouse", "Officetel"), 5), (("Văn phòng",), 6),
    (("Mặt bằng",), 12), (("Khách sạn", "Nhà hàng", "Căn hộ dịch vụ"), 13), (("Kho", "Xưởng"), 14), (("Phòng trọ", "Nhà trọ"), 15), (("Công nghiệp",), 57),
)
SALE_NAMES = {
    "Nhà hẻm ngõ": "Bán nhà riêng", "Nhà mặt tiền phố": "Bán nhà riêng", "Căn hộ chung cư": "Bán căn hộ chung cư", "Đất thổ cư": "Bán đất thổ cư",
    "Nhà biệt thự, liền kề": "Bán biệt thự", "Đường nội bộ": "Bán nhà phố dự án", "Đất nền dự án": "Bán đất nền dự án", "Đất nông nghiệp": "Bán đất nông, lâm nghiệp",
    "Căn hộ dịch vụ": "Bán căn hộ Mini, Dịch vụ", "Căn hộ tập thể, cư xá": "Bán căn hộ chung cư", "Căn hộ Penthouse": "Bán căn hộ chung cư",
    "Đất kho xưởng": "Bán đất thổ cư", "Căn hộ Officetel": "Bán căn hộ chung cư",
}
RENT_NAMES = {
    "Căn hộ chung cư": "Căn hộ chung cư", "Nhà mặt tiền phố": "Nhà phố", "Căn hộ dịch vụ": "Nhà hàng - Khách sạn", "Phòng trọ, nhà trọ": "Phòng trọ", "Nhà hẻm ngõ": "Nhà riêng",
    "Nhà biệt thự, liền kề": "Biệt thự", "Văn phòng": "Văn phòng", "Nhà xưởng, kho bãi": "Nhà Kho - Xưởng", "Đường nội bộ": "Nhà phố", "Căn hộ Penthouse": "Căn hộ chung cư",
    "Căn hộ tập thể, cư xá": "Căn hộ chung cư", "Căn hộ Officetel": "Căn hộ chung cư",
}
#: Papers of ownership by phrase.
PAPERS = ((("sổ hồng", "sổ đỏ", "đã có sổ"), 1), (("hợp đồng mua bán", "hđmb"), 2), (("đang chờ sổ",), 3), (("giấy tờ hợp lệ",), 4))


def first_phrase(text: Column, phrases: tuple[tuple[tuple[str, ...], int], ...], default: Column) -> Column:
    """The number of the first entry of which the text, whatever its case, holds a phrase."""
    low, out = F.lower(text), None
    for names, number in phrases:
        hit = low.rlike("|".join(n.lower() for n in names))
        out = F.when(hit, number) if out is None else out.when(hit, number)
    return out.otherwise(default)


def renamed_by_pair(pairs: dict[tuple[str, str], str], first: Column, second: Column, default: Column) -> Column:
    """The entry of a small map whose key is a pair of values, else the default."""
    mapping = F.create_map(*[F.lit(x) for (a, b), v in pairs.items() for x in (f"{a}\t{b}", v)])
    return F.coalesce(F.try_element_at(mapping, F.concat_ws("\t", first, second)), default)


def property_columns(category: Column, trade: Column, papers: Column) -> dict[str, Column]:
    """property_type, type_id, cat_id (1 homes, 2 land, 3 rent) and stratum_id of a listing; trades are mua, bán and thuê."""
    names = {(t, c): n for t in ("mua", "bán") for c, n in SALE_NAMES.items()} | {("thuê", c): n for c, n in RENT_NAMES.items()}
    rent, two = trade == "thuê", F.lit(2)
    return {
        "property_type": renamed_by_pair(names, trade, category, category),
        "type_id": F.when(rent, first_phrase(category, RENT_TYPES, two)).otherwise(first_phrase(category, SALE_TYPES, two)),
        "cat_id": F.when(rent, 3).otherwise(first_phrase(category, ((("Đất thổ cư", "Đất nền", "Nông nghiệp", "Lâm nghiệp"), 2),), F.lit(1))),
        "stratum_id": first_phrase(papers, PAPERS, F.lit(None).cast("int")),
    }


def listing_type(raw: Column, unit: Column, category: Column) -> Column:
    """'s' for a sale, 'u' for a rent: by the word of the type, else by a monthly unit, else by the category of rents; a sale
    if none of these tells."""
    word, per = F.lower(F.trim(raw)), F.lower(F.trim(unit))
    # Words of the two types, units of rents, and the category of rents.
    sale, rent, monthly, rents = ("s", "ban", "mua", "cần bán", "can ban"), ("u", "thue", "thuê", "cho thuê", "cho thue"), ("tháng", "thang"), 3
    return F.when(word.isin(*sale), "s").when(word.isin(*rent), "u").when(per.isin(*monthly), "u").when(category == rents, "u").otherwise("s")
