"""Fixed values of the document-relation domain: names, priorities and maps that results depend on."""

from __future__ import annotations

# --- fixed values ---

CLAUSE_LEVELS = ("dieu", "khoan", "diem")

LEVEL_NAMES = {"diem": "Điểm", "khoan": "Khoản", "dieu": "Điều"}

#: Priority of a relation where one target of a clause has several.
RELATION_PRIORITY = {
    "sua_doi_bo_sung": 110,
    "thay_the": 100,
    "bai_bo": 90,
    "huy_bo": 80,
    "sua_doi": 80,
    "bo_sung": 80,
    "dinh_chi": 80,
    "ngung_hieu_luc": 80,
    "dinh_chinh": 80,
    "keo_dai_hieu_luc": 70,
    "huong_dan": 60,
    "quy_dinh_chi_tiet": 60,
    "can_cu": 40,
    "dan_chieu": 20,
}

#: Conflict groups of a target document, the strongest first.
CONFLICT_GROUPS = (("sua_doi_bo_sung", "sua_doi", "bo_sung"), ("thay_the",), ("bai_bo",), ("huy_bo",))

#: Relation that a clause relation implies between the documents; others imply themselves.
INFERRED_RELATION = {
    "sua_doi_bo_sung": "sua_doi_bo_sung",
    "sua_doi": "sua_doi_bo_sung",
    "bo_sung": "sua_doi_bo_sung",
    "thay_the": "sua_doi_bo_sung",
    "bai_bo": "sua_doi_bo_sung",
    "huy_bo": "sua_doi_bo_sung",
    "dinh_chi": "sua_doi_bo_sung",
    "huong_dan": "huong_dan",
    "quy_dinh_chi_tiet": "huong_dan",
}

#: Target keys of these levels are left out of inference.
NOT_INFERRED_LEVELS = ("muc_", "phan_", "chuong_")

#: Curated list key -> (relation, whether the list's documents act on this one).
CURATED_KEYS = {
    "van_ban_can_cu": ("can_cu", False),
    "van_ban_dan_chieu": ("dan_chieu", False),
    "van_ban_bi_dinh_chinh": ("dinh_chinh", False),
    "van_ban_bi_thay_the": ("thay_the", False),
    "van_ban_duoc_huong_dan": ("huong_dan", False),
    "van_ban_duoc_sua_doi_bo_sung": ("sua_doi_bo_sung", False),
    "van_ban_duoc_hop_nhat": ("hop_nhat", False),
    "van_ban_bi_bai_bo": ("bai_bo", False),
    "van_ban_bi_dinh_chi": ("dinh_chi", False),
    "van_ban_bi_huy_bo": ("huy_bo", False),
    "van_ban_duoc_quy_dinh_chi_tiet": ("quy_dinh_chi_tiet", False),
    "van_ban_duoc_keo_dai_hieu_luc": ("keo_dai_hieu_luc", False),
    "van_ban_bi_ngung_hieu_luc": ("ngung_hieu_luc", False),
    "van_ban_quy_dinh_chi_tiet": ("quy_dinh_chi_tiet", True),
    "van_ban_huong_dan": ("huong_dan", True),
    "van_ban_hop_nhat": ("hop_nhat", True),
    "van_ban_sua_doi_bo_sung": ("sua_doi_bo_sung", True),
    "van_ban_dinh_chinh": ("dinh_chinh", True),
    "van_ban_thay_the": ("thay_the", True),
    "van_ban_bai_bo": ("bai_bo", True),
    "van_ban_dinh_chi": ("dinh_chi", True),
    "van_ban_huy_bo": ("huy_bo", True),
    "van_ban_keo_dai_hieu_luc": ("keo_dai_hieu_luc", True),
    "van_ban_ngung_hieu_luc": ("ngung_hieu_luc", True),
}

#: Relations that a reset keeps.
PRESERVED_RELATIONS = ("bao_gom", "bao_gom_sau_bo_sung")

#: Clause shapes that a reference may have, besides the whole document.
VALID_CLAUSE_SHAPES = ((), ("dieu",), ("diem", "dieu"), ("dieu", "khoan"), ("diem", "dieu", "khoan"))

#: Letters of points, in order.
POINT_LETTERS = "a b c d đ e g h i k l m n o p q r s t u v x y"

#: Last part of a document number that lacks its authority.
INCOMPLETE_SUFFIXES = ("ND", "NĐ", "QD", "QĐ", "TT", "TTLT", "NQ", "CT", "VB")

#: Relations that a higher authority's document doesn't have to a lower one's, and the reverse.
UPPER_TO_LOWER_RESTRICTED = ("quy_dinh_chi_tiet", "hop_nhat", "huong_dan", "can_cu")
LOWER_TO_UPPER_RESTRICTED = (
    "bai_bo", "thay_the", "huy_bo", "dinh_chi", "hop_nhat", "ngung_hieu_luc", "keo_dai_hieu_luc", "sua_doi_bo_sung", "sua_doi", "bo_sung",
)

#: z of a two-sided 95 % interval.
Z_95 = 1.959963984540054

# --- end of fixed values ---
