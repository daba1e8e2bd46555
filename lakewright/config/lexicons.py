"""Lexicons as data. Every operator takes them as parameters; these are the defaults."""

from __future__ import annotations

# They decide results and are stated as the data model gives them.
SENTIMENT = {
    "편리": 0.85, "편의": 0.80, "빠르": 0.80, "간편": 0.85, "좋": 0.80, "굿": 0.80, "훌륭": 0.90, "만족": 0.85, "추천": 0.85,
    "쉽": 0.80, "편하": 0.80, "깔끔": 0.75, "안정": 0.80, "친절": 0.80, "감사": 0.85, "개선": 0.70, "업데이트": 0.65, "해결": 0.75,
    "불편": 0.20, "느리": 0.20, "오류": 0.10, "버그": 0.10, "에러": 0.10, "강제종료": 0.05, "팅김": 0.10, "먹통": 0.05,
    "최악": 0.05, "짜증": 0.10, "불만": 0.15, "실망": 0.15, "어렵": 0.25, "복잡": 0.25, "답답": 0.20, "느림": 0.20,
}
ADVERBS = {
    "매우": 1.3, "정말": 1.3, "너무": 1.2, "진짜": 1.2, "엄청": 1.3, "완전": 1.2, "굉장히": 1.3, "극도로": 1.4,
    "좀": 0.8, "약간": 0.8, "조금": 0.8, "살짝": 0.7,
}
NEGATIONS = ("안", "못", "없", "아니", "않")
CATEGORY_TERMS = {
    "USABILITY": ("사용", "편리", "편의", "인터페이스", "UI", "UX", "메뉴", "기능", "조작", "접근", "쉽", "어렵", "복잡", "간편", "편하"),
    "STABILITY": ("오류", "버그", "에러", "강제종료", "팅김", "먹통", "충돌", "안정", "불안정", "다운", "멈춤", "튕김"),
    "DESIGN": ("디자인", "화면", "레이아웃", "색상", "폰트", "글자", "깔끔", "예쁘", "구성", "아이콘"),
    "CUSTOMER_SUPPORT": ("고객", "상담", "CS", "고객센터", "응대", "문의", "지원", "도움", "답변", "서비스", "직원", "친절"),
    "SPEED": ("속도", "빠르", "느리", "로딩", "반응", "렉", "지연", "빠름", "느림", "쾌적", "버벅"),
}
BUG_WORDS = ("버그", "팅김", "오류", "에러", "강제종료", "강제 종료", "먹통", "충돌", "다운됨", "다운돼", "다운되었")
REQUEST_WORDS = ("해달라", "고쳐줘", "개선해", "부탁", "요청", "수정해", "바꿔줘", "추가해")
