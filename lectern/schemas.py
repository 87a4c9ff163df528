"""Fixed schemas of tables and documents."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

BOOKS = "id string, sort int"
BOOK_CONTENTS = "id string, book_id string, language string, title string"
CHAPTERS = "id string, book_id string, sort int"
CHAPTER_CONTENTS = "id string, chapter_id string, language string, title string"
SECTIONS = "id string, book_id string, chapter_id string, sort int"
SECTION_CONTENTS = "id string, section_id string, language string, title string, content string, sub_title string"
BACKUP = "source_table string, source_id string, old_section_id string, book_sort int, chapter_sort int, section_sort int"

RECORD = "passage_id string, lang string, bible_id int, book_sort int, chapter_sort int, verse_sort int, content string, crawled_at timestamp"
DOCUMENT = (
    "version string, version_id int, language string, crawled_at timestamp, books array<struct<book_sort:int,book_name:string,book_usfm:string,"
    "chapters:array<struct<chapter_sort:int,verses:array<struct<verse_sort:int,sub_title:string,content:string,note:string,cross_ref:string>>>>>>"
)
SPEC = "title string, version string, books array<struct<number:int,testament:string,testament_zh:string,name_zh:string,name_en:string,total_chapters:int,total_verses:int,verses_per_chapter:map<string,int>>>"


@dataclass(frozen=True)
class Library:
    """The six tables: a structural row per level, and its content rows per language."""

    books: DataFrame
    book_contents: DataFrame
    chapters: DataFrame
    chapter_contents: DataFrame
    sections: DataFrame
    section_contents: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}
