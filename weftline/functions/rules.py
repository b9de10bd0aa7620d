"""Fixed values of the clause rules: names and phrases of Vietnamese legal language. Blanks in phrases stand for any white space."""

from __future__ import annotations

# --- fixed values ---

#: Document types by key, in the order in which phrases are tried.
DOCUMENT_TYPES = {
    "hienphap": "Hiến pháp",
    "boluat": "Bộ luật",
    "luat": "Luật",
    "phaplenh": "Pháp lệnh",
    "nghiquyet": "Nghị quyết",
    "nghiquyetlientich": "Nghị quyết liên tịch",
    "quyetdinh": "Quyết định",
    "nghidinh": "Nghị định",
    "thongtu": "Thông tư",
    "thongtulientich": "Thông tư liên tịch",
    "congvan": "Công văn",
    "chithi": "Chỉ thị",
    "congdien": "Công điện",
    "dieuuocquocte": "Điều ước quốc tế",
    "hiepdinh": "Hiệp định",
    "huongdan": "Hướng dẫn",
    "kehoach": "Kế hoạch",
    "vanban": "Văn bản",
    "lenh": "Lệnh",
    "saclenh": "Sắc lệnh",
}

LEVEL_WORDS = {"điều": "dieu", "khoản": "khoan", "điểm": "diem"}

#: Types that a title alone identifies.
TITLED_TYPES = ("luat", "boluat", "hienphap", "phaplenh")

#: Words of an action, by relation. {type} is any document type or clause level.
CUE_PHRASES = {
    "sua_doi_bo_sung": (
        "sửa đổi , bổ sung", "sửa đổi và bổ sung", "sửa đổi", "bổ sung", "bãi bỏ các cụm từ", "bãi bỏ cụm từ", "bãi bỏ từ",
        "bỏ các cụm từ", "bỏ cụm từ", "bỏ từ", "thay cụm từ", "thay các cụm từ", "thay từ", "thay thế các cụm từ", "thay thế cụm từ",
        "thay thế từ", "thay thế phụ lục", "thay thế danh mục", "thay thế mẫu", "thay thế biểu mẫu", "điều chỉnh , bổ sung",
        "bãi bỏ một phần", "bãi bỏ một số điều", "bãi bỏ một số", "thay thế một số", "bãi bỏ , thay thế một số", "bãi bỏ , thay thế một phần",
        "bãi bỏ , thay thế các cụm từ", "bãi bỏ , thay thế các điều", "bãi bỏ , thay thế cụm từ", "thay thế , bãi bỏ một số",
        "thay thế , bãi bỏ một phần", "thay thế , bãi bỏ các cụm từ", "thay thế , bãi bỏ các điều", "thay thế , bãi bỏ cụm từ",
    ),
    "thay_the": ("thay thế",),
    "bai_bo": ("bãi bỏ toàn bộ", "bãi bỏ", "chấm dứt hiệu lực", "thu hồi"),
    "huy_bo": ("hủy bỏ", "thu hồi , hủy bỏ", "thu hồi và hủy bỏ"),
    "dinh_chinh": ("đính chính lỗi kỹ thuật", "đính chính sai sót", "đính chính nội dung", "đính chính", "sửa cụm từ", "sửa tiêu đề"),
    "dinh_chi": (
        "đình chỉ hiệu lực thi hành", "đình chỉ việc thi hành", "đình chỉ thi hành", "tạm đình chỉ thi hành", "tạm đình chỉ hiệu lực",
    ),
    "ngung_hieu_luc": ("ngưng hiệu lực thi hành", "ngưng hiệu lực toàn bộ", "ngưng hiệu lực"),
    "keo_dai_hieu_luc": (
        "thống nhất tiếp tục kéo dài thời gian", "thống nhất tiếp tục kéo dài thời hạn", "thống nhất tiếp tục kéo dài hiệu lực",
        "kéo dài hiệu lực", "kéo dài thời gian", "kéo dài thời hạn",
    ),
    "quy_dinh_chi_tiet": ("quy định chi tiết và hướng dẫn thi hành", "quy định chi tiết"),
    "huong_dan": ("hướng dẫn thi hành", "hướng dẫn thực hiện", "hướng dẫn áp dụng"),
    "dan_chieu": (
        "theo đúng quy định của {type}", "theo quy định của {type}", "theo các quy định tại {type}", "theo quy định tại {type}",
        "theo quy định {type}", "quy định tại {type}", "được quy định trong {type}", "được quy định tại {type}",
        "thuộc phạm vi điều chỉnh của {type}", "trên cơ sở {type}", "tiếp tục có hiệu lực", "theo {type}", "tại {type}",
    ),
}

#: Passive forms: what stands before them is acted on, and a colon follows.
PASSIVE_PHRASES = {"sua_doi_bo_sung": ("được sửa đổi , bổ sung", "được sửa đổi", "được bổ sung")}

#: After the mention: its document expires, by replacement if this one's effect is named, else by repeal.
EXPIRY_REPLACED = ("hết hiệu lực kể từ ngày {doc} này có hiệu lực", "hết hiệu lực thi hành kể từ ngày {doc} này có hiệu lực", "hết hiệu lực từ ngày {doc} này có hiệu lực")
EXPIRY_REPEALED = ("hết hiệu lực thi hành", "hết hiệu lực")

#: Phrases after which a further document describes the one before and is no target.
SUBORDINATE_PHRASES = (
    "được sửa đổi", "sửa đổi , bổ sung", "quy định chi tiết", "qui định chi tiết", "hướng dẫn thực hiện quy định", "hướng dẫn thi hành",
    "về việc", "quy định ngưng hiệu lực thi hành", "sửa đổi", "bổ sung", "được bổ sung", "bãi bỏ", "thay thế",
)

#: Objects right after an action that make it no legal one: (reason, actions, objects).
DISTRACTORS = (
    ("non_legal_bo_sung", ("bổ sung",), ("hồ sơ", "thông tin", "tài liệu", "nguồn lực", "nhiệm vụ", "kinh phí", "tiêu chí", "định mức", "chỉ tiêu", "phương án")),
    ("non_legal_dinh_chi", ("đình chỉ", "tạm đình chỉ", "ngưng hiệu lực"), ("hoạt động", "giấy phép", "chứng chỉ", "công nhận", "thi hành án", "chứng nhận", "đăng ký", "kinh doanh")),
    ("non_legal_huy_bo", ("hủy bỏ", "thu hồi"), ("công nhận", "thẻ", "chứng chỉ", "tài sản", "giấy phép", "chứng nhận", "đăng ký", "kết quả", "hồ sơ")),
    ("non_legal_keo_dai", ("kéo dài thời gian", "kéo dài thời hạn"), ("gia hạn", "giữ chức", "nâng bậc lương", "nâng lương", "xử lý kỷ luật", "công tác", "nghỉ hưu", "thanh tra")),
)
LOOK_AHEAD = 60

#: Notes in brackets that tell a document's history or short name.
PROVENANCE_WORDS = ("được sửa đổi", "được bổ sung", "sau đây gọi")

# --- end of fixed values ---
