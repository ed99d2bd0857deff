"""Files of code repositories: which are text, how their comments look, two text rows for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import file_name, file_suffix
from loomspark.session import lookup

#: Suffixes of files that are never text. Fixed values.
BINARY = """
.7z .a .aac .arrow .avi .bin .bmp .bz2 .class .dat .db .deb .debug .dll .dmg .doc .docx .dylib .ear .egg .eot .exe .flac .flv .gguf
.gif .gz .h5 .hdf5 .ico .img .ipynb_checkpoints .iso .jar .joblib .jpeg .jpg .key .lib .m4a .map .mkv .mov .mp3 .mp4 .nbt .npy .npz
.o .obj .ogg .onnx .otf .parquet .pb .pdf .pickle .pkl .png .ppt .pptx .profraw .pyc .pyd .pyo .rar .rpm .so .sqlite .sqlite3 .svgz
.swf .tar .tflite .tiff .ttf .war .wasm .wav .webm .webp .whl .wmv .woff .woff2 .xls .xlsx .xz .zip
""".split()

#: Marks (line; or open and close of a block) and the suffixes that use them, the common ones. A table of any length can be
#: given besides. Fixed values.
SUFFIXES = {
    ("#", None, None): """.am .awk .bash .build .cfg .clang-format .clang-tidy .cmake .common .conf .config .cr .csv .default .deps
        .dockerfile .editorconfig .env .ex .example .exs .feature .fish .gemspec .gitattributes .gitignore .gitmodules .hcl .in .jl
        .kconfig .log .mak .makefile .mk .mod .nim .nix .patch .pem .perl .pl .pm .pro .profile .properties .ps1 .py .pyw .r .rb .rbs
        .readme .rules .rv .s .sample .schema .sed .service .sh .socs .spec .src .sum .t .target .tbl .tc .template .test .tf .tmpl
        .toml .txt .typed .vm .yaml .yml .zsh""",
    ("dnl ", None, None): ".ac .m4",
    (";", None, None): ".asm .clj .cljc .cljs .el .ini .sa",
    ("REM ", None, None): ".bat .cmd",
    ("//", None, None): """.c .cat .cc .cjs .cl .cocci .comp .cpp .cs .cu .cuh .cxx .dart .def .dot .dts .dtsi .dtso .frag .fs .fsh .fsx .glsl .go
        .gradle .groovy .h .hh .hpp .hxx .idl .inc .inl .java .js .jsx .kt .kts .lds .less .metal .mjs .mm .php .reg .rs .sass .scala
        .script .scss .styl .swift .ts .tsx .vert .vsh .wgsl .x .xs .zig""",
    ("%", None, None): ".bib .erl .hrl .m .sty",
    ("--", None, None): ".asn1 .hs .lua .sql",
    ('"', None, None): ".nvim .vim",
    ("'", None, None): ".vb",
    (None, "<!--", "-->"): ".astro .entitlements .htm .html .markdown .md .mdx .pbxproj .plist .storyboard .svg .svelte .ui .vue .xcscheme .xml .xsd .xsl",
    (None, "/*", "*/"): ".css .json .json5 .jsonc .l .ld .mcmeta .po .proto .webmanifest .xpm .y",
    (None, "#", ""): ".gql .graphql",
    (None, "{#", "#}"): ".j2 .jinja .peb",
    (None, "..", ""): ".rst",
    (None, "%", ""): ".tex",
}

#: The same for whole names in lower case, which come before suffixes. Fixed values.
NAMES = {
    ("#", None, None): """.clang-format .clang-tidy .cocciconfig .dockerignore .document .ecrc .editorconfig .env .flake8 .gitattributes
        .gitignore .gitkeep .gitmodules .kunitconfig .mailmap .name .npmrc .prettierignore .pylintrc .rdoc_options .yamllint ar-lib
        authors cargo.lock cargo.toml changes cmakelists.txt codeowners codingstyle compile config.guess config.log config.status
        config.sub configure configure.ac configure.in copying credits depcomp docker-compose.yaml docker-compose.yml dockerfile gemfile
        gemfile.lock gradlew install-sh justfile license ltmain.sh maintainers makefile makefile.am makefile.in meson.build missing
        mix.lock mkinstalldirs notice pipfile pnpm-lock.yaml poetry.lock procfile pubspec.lock py-compile pyproject.toml rakefile
        requirements.txt setup.cfg speak stamp-h.in stamp-h1 submittingpatches test-driver thanks todo vagrantfile yarn.lock""",
    ("dnl ", None, None): "aclocal.m4",
    ("//", None, None): "build.gradle config.h config.h.in go.mod go.sum jenkinsfile settings.gradle",
    (None, "<!--", "-->"): "changelog code_of_conduct contributing pom.xml readme security",
    (None, "/*", "*/"): ".prettierrc composer.json flake.lock package-lock.json package.json pipfile.lock tsconfig.json",
}


STYLE = "struct<line: string, open: string, close: string>"


def _marks(marks: dict, key: Column) -> Column:
    """struct(line, open, close) of a key by a literal map, so that files are not joined; null where it has none."""
    pairs = [F.lit(x) for keys in marks.values() for x in keys.split()]
    values = [F.struct(*(F.lit(m).cast("string").alias(n) for m, n in zip(mark, ("line", "open", "close"), strict=True))) for mark, keys in marks.items() for _ in keys.split()]
    return F.try_element_at(F.map_from_arrays(F.array(*pairs), F.array(*values)), key)


def read_text_files(files: DataFrame) -> DataFrame:
    """files (path, content, any others) with text instead of content; binary suffixes, NUL bytes and invalid UTF-8 drop out."""
    kept = files.filter(~file_suffix(F.col("path")).isin(BINARY)).filter(~F.contains("content", F.lit(b"\x00")))
    return kept.withColumn("text", F.try_validate_utf8(F.col("content").cast("string"))).drop("content").filter("text is not null")


def comment_style(files: DataFrame, suffixes: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """files (path, any others) with line, open, close: by name, else by suffix, else as in ``# <!-- -->``.

    suffixes, names: tables (key, line, open, close; a key once, in lower case) that come before those above, see
    :func:`loomspark.sources.readers.read_comment_styles`. Without them files meet no join.
    """
    found = files.withColumns({"__name": F.lower(file_name(F.col("path"))), "__suffix": file_suffix(F.col("path"))})
    ways = []
    for key, given, marks in (("__name", names, NAMES), ("__suffix", suffixes, SUFFIXES)):
        if given is not None:
            rows = given.select(F.col("key").alias(key), F.struct("line", "open", "close").cast(STYLE).alias(f"{key}_given"))
            found = found.join(lookup(rows), key, "left")
            ways.append(F.col(f"{key}_given"))
        ways.append(_marks(marks, F.col(key)))
    other = F.struct(F.lit(None).cast("string").alias("line"), F.lit("# <!--").alias("open"), F.lit("-->").alias("close"))
    return found.withColumn("__style", F.coalesce(*ways, other)).select(*files.columns, "__style.*")


def comment_header(path: Column, repo: Column, branch: Column, line: Column, open_: Column, close: Column) -> Column:
    """Header naming file, repository and, unless it is main or master, branch."""
    on = F.when(branch.isin("main", "master"), "").otherwise(F.concat(F.lit(" | Branch: "), branch))
    lines = F.concat(line, F.lit(" File: "), path, F.lit("\n"), line, F.lit(" Repository: "), repo, on, F.lit("\n\n"))
    block = F.concat(open_, F.lit(" File: "), path, F.lit(" | Repository: "), repo, on)
    return F.when(line.isNotNull(), lines).otherwise(F.concat(block, F.when(close != "", F.concat(F.lit(" "), close)).otherwise(F.lit("")), F.lit("\n\n")))


def repo_text_rows(files: DataFrame, suffixes: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """Text files (url, repo, branch, path, text) to two rows each: the text, and the text with a header. text, source, ai_enhanced."""
    styled = comment_style(files, suffixes, names)
    header = comment_header(*(F.col(c) for c in ("path", "repo", "branch", "line", "open", "close")))
    return styled.select(F.explode(F.array(F.col("text"), F.concat(header, F.col("text")))).alias("text"), F.col("url").alias("source"), F.lit(False).alias("ai_enhanced"))


def list_branches(listing: DataFrame) -> DataFrame:
    """Remote branch lines (repo, line) to repo, branch; a repository without branches has main."""
    line = F.regexp_replace("line", r"^\s+|\s+$", "")
    name = F.when((line != "") & ~F.startswith(line, F.lit("origin/HEAD")), F.regexp_replace(line, "^origin/", ""))
    found = listing.groupBy("repo").agg(F.collect_list(name).alias("all"))
    return found.select("repo", F.explode(F.when(F.size("all") > 0, F.col("all")).otherwise(F.array(F.lit("main")))).alias("branch"))
