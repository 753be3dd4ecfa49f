"""Known recognition errors and their corrections."""

#: Fixed values, in the order in which they are applied: each pair sees what those before it have written.
CORRECTIONS: list[tuple[str, str]] = [
    ("hoyết", "quyết"),
    ("Erở nh", "Trong đó"),
    ("thăng", "thẳng"),
    ("qhyết", "quyết"),
    ("hãnh", "hành"),
    ("thí", "thi"),
    ("ĐÓI CHIẾU", "ĐỐI CHIẾU"),
    ("KÉT QUÁ", "KẾT QUẢ"),
    ("THỊ HÀNH", "THI HÀNH"),
    ("Trảđơn", "Trả đơn"),
    ("khân cấp", "khẩn cấp"),
    ("viện lập", "viên lập"),
    ("THỚNG", "TRƯỞNG"),
    ("TRƯỚNG", "TRƯỞNG"),
    ("đên", "đến"),
    ("sô:", "số:"),
    ("ĐƑT", "ĐVT"),
    ("gôm", "gồm"),
    ("bao gôm", "bao gồm"),
    ("Trong hoyết", "Trọng điểm"),
    ("trong hoyết", "trọng điểm"),
    ("Erở\nnh", "Trong đó"),
    ("phải thí hãnh", "phải thi hành"),
    ("phải thí", "phải thi"),
    ("Tình\nthi hành án", "Tình thi hành án"),
    ("\"vi hành án", "thi hành án"),
    ("nước và chỉ tr", "Nhà nước và chỉ tr"),
    ("giao nhận thăng", "giao nhận thẳng"),
    ("thăng)", "thẳng)"),
    ("Án\nphí", "Án phí"),
    ("Phạt\ntiền", "Phạt tiền"),
    ("Truy\nthu", "Truy thu"),
    ("sung\nquỹ", "sung quỹ"),
    ("Tịch\nthu", "Tịch thu"),
    ("Thu\nhồi", "Thu hồi"),
    ("tiêu\nhuỷ", "tiêu huỷ"),
    ("lại\ntiền", "lại tiền"),
    ("lại\ntài", "lại tài"),
    ("khẩn\ncấp", "khẩn cấp"),
    ("Đình\nchỉ", "Đình chỉ"),
    ("Miễn,\ngiảm", "Miễn, giảm"),
    ("PHÔ CUC TRƯỜNG", "PHÓ CỤC TRƯỞNG"),
    ("PHÔ CỤC TRƯỜNG", "PHÓ CỤC TRƯỞNG"),
    ("só TT", "Số TT"),
    ("só phai", "số phải"),
    ("Tieu chí", "Tiêu chí"),
    ("quyét dinh", "quyết định"),
    ("Tǒng só", "Tổng số"),
    ("tài sán", "tài sản"),
    ("Trong dó", "Trong đó"),
    ("Cháp hành", "Chấp hành"),
    ("Trá don", "Trả đơn"),
    ("Dinh chi", "Đình chỉ"),
    ("Miēn, giam", "Miễn, giảm"),
    ("chú dong", "chủ động"),
    ("Các khoan", "Các khoản"),
    ("nōp Nhà nuóc", "nộp Nhà nước"),
    ("Nhà nuóc", "Nhà nước"),
    ("Phat tièn", "Phạt tiền"),
    ("Ban án", "Bản án"),
    ("Tich thu", "Tịch thu"),
    ("sung quy nhà nuóc", "sung quỹ nhà nước"),
    ("bát chính", "bất chính"),
    ("Thu hòi", "Thu hồi"),
    ("quyèn sùr dung", "quyền sử dụng"),
    ("tieu huy", "tiêu hủy"),
    ("vat chung", "vật chứng"),
    ("duong su", "đương sự"),
    ("khǎn cáp", "khẩn cấp"),
    ("khán cáp", "khẩn cấp"),
    ("tam thòi", "tạm thời"),
    ("bàng tièn", "bằng tiền"),
    ("bàng tài", "bằng tài"),
    ("theo don", "theo đơn"),
    ("Xác dinh", "Xác định"),
    ("cuong ché", "cưỡng chế"),
    ("yèu càu", "yêu cầu"),
    ("cúa duong", "của đương"),
    ("co quan chúrc nǎng", "cơ quan chức năng"),
    ("chi tiét tùrng loai", "chi tiết từng loại"),
    ("hoǎc", "hoặc"),
    ("tièn", "tiền"),
]
