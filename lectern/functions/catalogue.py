"""The canon: 66 books with code, names and number of chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Code, chapters, Chinese name, English name, in canonical order.
_BOOKS = """
GEN 50 創世記 Genesis
EXO 40 出埃及記 Exodus
LEV 27 利未記 Leviticus
NUM 36 民數記 Numbers
DEU 34 申命記 Deuteronomy
JOS 24 約書亞記 Joshua
JDG 21 士師記 Judges
RUT 4 路得記 Ruth
1SA 31 撒母耳記上 1 Samuel
2SA 24 撒母耳記下 2 Samuel
1KI 22 列王紀上 1 Kings
2KI 25 列王紀下 2 Kings
1CH 29 歷代志上 1 Chronicles
2CH 36 歷代志下 2 Chronicles
EZR 10 以斯拉記 Ezra
NEH 13 尼希米記 Nehemiah
EST 10 以斯帖記 Esther
JOB 42 約伯記 Job
PSA 150 詩篇 Psalms
PRO 31 箴言 Proverbs
ECC 12 傳道書 Ecclesiastes
SNG 8 雅歌 Song of Songs
ISA 66 以賽亞書 Isaiah
JER 52 耶利米書 Jeremiah
LAM 5 耶利米哀歌 Lamentations
EZK 48 以西結書 Ezekiel
DAN 12 但以理書 Daniel
HOS 14 何西阿書 Hosea
JOL 3 約珥書 Joel
AMO 9 阿摩司書 Amos
OBA 1 俄巴底亞書 Obadiah
JON 4 約拿書 Jonah
MIC 7 彌迦書 Micah
NAM 3 那鴻書 Nahum
HAB 3 哈巴谷書 Habakkuk
ZEP 3 西番雅書 Zephaniah
HAG 2 哈該書 Haggai
ZEC 14 撒迦利亞書 Zechariah
MAL 4 瑪拉基書 Malachi
MAT 28 馬太福音 Matthew
MRK 16 馬可福音 Mark
LUK 24 路加福音 Luke
JHN 21 約翰福音 John
ACT 28 使徒行傳 Acts
ROM 16 羅馬書 Romans
1CO 16 哥林多前書 1 Corinthians
2CO 13 哥林多後書 2 Corinthians
GAL 6 加拉太書 Galatians
EPH 6 以弗所書 Ephesians
PHP 4 腓立比書 Philippians
COL 4 歌羅西書 Colossians
1TH 5 帖撒羅尼迦前書 1 Thessalonians
2TH 3 帖撒羅尼迦後書 2 Thessalonians
1TI 6 提摩太前書 1 Timothy
2TI 4 提摩太後書 2 Timothy
TIT 3 提多書 Titus
PHM 1 腓利門書 Philemon
HEB 13 希伯來書 Hebrews
JAS 5 雅各書 James
1PE 5 彼得前書 1 Peter
2PE 3 彼得後書 2 Peter
1JN 5 約翰一書 1 John
2JN 1 約翰二書 2 John
3JN 1 約翰三書 3 John
JUD 1 猶大書 Jude
REV 22 啟示錄 Revelation
"""
#: The first book of the second testament.
NEW_FROM = 40


def books() -> list[tuple[int, str, str, str, int]]:
    """(number, code, Chinese name, English name, chapters)."""
    rows = [line.split(" ", 3) for line in _BOOKS.strip().splitlines()]
    return [(i, code, zh, en, int(n)) for i, (code, n, zh, en) in enumerate(rows, 1)]


def catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(books(), "book_sort int, usfm string, name_zh string, name_en string, total_chapters int")
