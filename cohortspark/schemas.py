"""Record types of the variant engine as explicit Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


SEC_ALT = "struct<start:int,end:int,ref:string,alt:string,type:string>"
CALLS = f"sample_id int, file_id int, chrom string, start int, end int, ref string, alt string, type string, sec_alts array<{SEC_ALT}>, gt string, dp int, ad array<int>, filter string"
SAMPLES = "sample_id int, name string, indexed boolean"
COHORTS = "cohort string, sample_id int"
CALL_REGIONS = "chrom string, start int, end int, kind string, ref string, alt string, type string, allele_count int, depth int, pass boolean, sample_id int"
STORED_REGIONS = f"{CALL_REGIONS}, span int, batch_id string"
VARIANT_KEYS = "pos int, ref string, alt string, chrom string, span int, batch_id string"
VARIANT_COUNTS = "chrom string, pos int, ref string, alt string, slot string, allele int, sample_id int"
STORED_COUNTS = f"{VARIANT_COUNTS}, span int, batch_id string"
SUPERSEDED = "sample_id int, chrom string, span int, batch_id string, by_batch string"
VARIANT_STATS = "chrom string, pos int, ref string, alt string, cohort string, num_samples int, ref_ac int, alt_ac int, maf float, maf_allele string, mgf float, hwe float, call_rate float, pass_rate float, opr float, gt_counts map<string,int>"
GENE_SUMMARY = "gene string, transcript string, cases array<int>, controls array<int>"
GENOTYPES = "struct<noCall:array<int>,homRefCount:int,het:array<int>,homAlt:array<int>,otherGenotypes:map<string,array<int>>,alleleBases:array<string>>"
STATS = "struct<refAlleleCount:int,altAlleleCount:int,genotypesCount:map<string,int>,maf:float,mgf:float,mafAllele:string,numSamples:int,hwe:float,overallPassrate:float>"
SCORE = "struct<score:double,source:string,description:string>"
PROTEIN = f"struct<uniprotAccession:string,uniprotName:string,position:int,reference:string,alternate:string,uniprotVariantId:string,functionalDescription:string,substitutionScores:array<{SCORE}>,keywords:array<string>,features:array<struct<id:string,start:int,end:int,type:string,description:string>>>"
CONSEQUENCE = f"struct<geneName:string,ensemblGeneId:string,ensemblTranscriptId:string,strand:string,biotype:string,exonNumber:int,transcriptAnnotationFlags:array<string>,cdnaPosition:int,cdsPosition:int,codon:string,proteinVariantAnnotation:{PROTEIN},sequenceOntologyTerms:array<struct<accession:string,name:string>>>"
POPULATION = "struct<study:string,population:string,refAllele:string,altAllele:string,refAlleleFreq:float,altAlleleFreq:float,refHomGenotypeFreq:float,hetGenotypeFreq:float,altHomGenotypeFreq:float>"
ANNOTATION = f"struct<id:string,xrefs:array<struct<id:string,source:string>>,hgvs:array<string>,displayConsequenceType:string,consequenceTypes:array<{CONSEQUENCE}>,populationFrequencies:array<{POPULATION}>,conservation:array<{SCORE}>,functionalScore:array<{SCORE}>>"
ALLELE_VARIANT = f"chromosome string, start int, end int, reference string, alternate string, numberOfSamples int, pass int, notPass array<int>, consequenceTypes array<string>, bioTypes array<string>, caddScaled float, ensemblGeneIds array<string>, genotypes {GENOTYPES}, type string, stats map<string,{STATS}>, annotation {ANNOTATION}"
SAMPLE_COLLECTION = "samples map<string,string>, cohorts map<string,array<int>>"
LOAD_BATCHES = "batch_id string, file_ids array<int>, status string"

NAMES = ("calls", "samples", "cohorts", "call_regions", "stored_regions", "variant_keys", "variant_counts", "stored_counts", "superseded", "variant_stats", "gene_summary", "allele_variant", "sample_collection", "load_batches")


def schema(name: str) -> T.StructType:
    """The schema of a record type by its lower-case name."""
    return _schema(globals()[name.upper()])
