"""Explicit schemas of the manifests; every column may be null and none is inferred."""

from pyspark.sql import types as T


SIMPLE = {"string": T.StringType, "long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "boolean": T.BooleanType}
VERDICT = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("passed", T.BooleanType()), T.StructField("metric", T.DoubleType()), T.StructField("detail", T.StringType()),
]))


def of(columns: str) -> T.StructType:
    """Columns as `name type, ...`, also where no session exists yet; array<type> of simple types is allowed."""

    def kind(name: str) -> T.DataType:
        return T.ArrayType(SIMPLE[name[6:-1]]()) if name.startswith("array<") else SIMPLE[name]()

    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, kind(of_type)) for name, of_type in pairs])


CATALOG = of("fname string, text string, lang string, duration double, gender string, speaker_id long, row_index long, source_file string")
REFERENCE = of(
    "ref_id string, lang string, speaker_id long, gender string, source_repo string, source_split string, source_file string, row_index long, "
    "fname string, ref_text string, duration double, local_audio_path string, status string, error string"
)
PREPARED = T.StructType([
    *REFERENCE.fields,
    *of(
        "source_format string, decode_backend string, source_sr int, target_sr int, resample_method string, channels_in int, norm_method string, "
        "gain_db double, out_duration double, out_peak_dbfs double, out_rms_dbfs double, qc_flags array<string>, prepared_audio_path string"
    ).fields,
])
SENTENCES = of("id string, language string, language_name string, topic string, sentence_type string, text string, word_count int, char_count int, seed long")
UTTERANCES = of(
    "utt_id string, audio_filepath string, text string, speaker_id long, gender string, language string, ref_id string, ref_audio_path string, "
    "duration double, topic string, sentence_type string, status string, error string"
)
DATASET = T.StructType([
    *UTTERANCES.fields,
    *of("qc_passed boolean, qc_reasons array<string>, asr_transcript string, cer double, speaker_sim double").fields,
    T.StructField("qc_checks", VERDICT),
])
