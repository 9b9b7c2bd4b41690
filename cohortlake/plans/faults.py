"""A view of the record table with all columns of the contract, in which every rule of the contract is broken somewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlake.plans.dims import records

CONTRACT_SQL = """
SELECT CASE WHEN k % 509 = 0 THEN concat('R-', CAST(k % 3 AS STRING)) ELSE record_id END AS record_id,
  study_no, title, author, doi, t_publication,
  CAST(CASE WHEN k % 211 = 0 THEN 1850 WHEN k % 223 = 0 THEN t_publication + 1 ELSE sampling_year END AS DOUBLE) AS time,
  CAST(sampling_year + CASE WHEN k % 227 = 0 THEN 1 ELSE -1 END AS DOUBLE) AS time_start, CAST(sampling_year AS DOUBLE) AS time_end,
  'Here' AS country, province, CASE WHEN k % 199 = 0 THEN 'Atlantis' ELSE 'East' END AS region,
  population_group AS population, CASE WHEN k % 131 = 0 THEN 'Robots' ELSE population_group END AS population_group,
  CASE WHEN k % 137 = 0 THEN 'Other' ELSE gender END AS gender,
  flag_occupational, false AS flag_disease, false AS flag_endemic_area, false AS flag_mixed_occupational,
  CASE WHEN k % 139 = 0 THEN 'Maybe' WHEN k % 3 = 0 THEN 'Exclude' ELSE 'Include' END AS inclusion_decision,
  CASE WHEN k % 6 = 0 THEN 'animal study' END AS exclusion_reason,
  CASE WHEN k % 149 = 0 THEN 'Saliva' ELSE sample_type END AS sample_type,
  CASE WHEN k % 29 = 0 THEN NULL WHEN k % 157 = 0 THEN 'Bone' ELSE blood_matrix END AS blood_matrix,
  analyte, CASE WHEN k % 163 = 0 THEN 'As(V)' ELSE analyte_species END AS analyte_species,
  CASE WHEN k % 167 = 0 THEN 'Mode' ELSE stat_type END AS stat_type, unit_original,
  CASE WHEN k % 173 = 0 THEN 0 ELSE sample_size END AS sample_size,
  CASE WHEN k % 31 = 0 THEN NULL WHEN k % 181 = 0 THEN 'Yes' ELSE adjusted END AS adjusted,
  CASE WHEN k % 37 = 0 THEN -1.0 ELSE initial_gm END AS initial_gm,
  CASE WHEN initial_gm IS NOT NULL AND k % 14 = 0 THEN initial_gm / 2 WHEN initial_gm IS NOT NULL AND k % 7 = 0 THEN initial_gm ELSE initial_mean END AS initial_mean,
  initial_sd, initial_median,
  CASE WHEN k % 41 = 0 THEN initial_median * 2 ELSE initial_p25 END AS initial_p25,
  CASE WHEN k % 43 = 0 THEN initial_median / 2 ELSE initial_p75 END AS initial_p75,
  CASE WHEN initial_gm IS NOT NULL AND k % 11 = 0 THEN initial_gm * 1.1 WHEN k % 47 = 0 THEN initial_max * 2 ELSE initial_min END AS initial_min,
  CASE WHEN initial_gm IS NOT NULL AND k % 13 = 0 THEN initial_gm * 0.9 ELSE initial_max END AS initial_max,
  CASE WHEN k % 53 = 0 THEN -0.5 WHEN k % 59 = 0 THEN 0.5 ELSE initial_gsd END AS initial_gsd,
  CASE WHEN sample_type <> 'Urine' THEN 'ug/L' WHEN k % 17 = 0 THEN 'mg/L' ELSE 'ug/g Cr' END AS unit_final,
  CASE WHEN k % 241 = 0 THEN 0.0 WHEN k % 19 = 0 THEN gm_direct * 1000 ELSE gm_direct END AS gm_summary,
  CASE WHEN k % 251 = 0 THEN -1.0 ELSE 1.5 END AS gsd_summary,
  CASE WHEN k % 2 = 0 THEN 'Median_Range→Wan_S2→GM' ELSE 'reported_GM' END AS conversion_path,
  CASE WHEN k % 61 = 0 THEN 'value_interpolated' WHEN k % 67 = 0 THEN 'value_interpolated_time' WHEN k % 71 = 0 THEN 'made_up; gm_from_median' WHEN k % 2 = 0 AND k % 10 <> 0 THEN 'gm_from_median;gm_from_range' END AS inferred_flags,
  CASE WHEN k % 271 = 0 THEN 'Robot' ELSE 'AI' END AS extracted_by, CASE WHEN k % 4 = 0 THEN 'no' ELSE 'Yes' END AS verified,
  'v1' AS snapshot_tag, '' AS row_hash
FROM (SELECT *, CAST(round(gm_direct * 100000) AS BIGINT) AS k FROM rec) AS r
"""


def contract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CONTRACT_SQL.replace("FROM rec)", "FROM {rec})"), rec=records(spark, sf_dir))
