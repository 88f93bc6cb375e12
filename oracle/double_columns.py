"""Generated by scripts/gen_double_columns.py: DOUBLE output columns per oracle."""

DOUBLE_COLUMNS = {
    'acei': [],
    'age': [],
    'antibiotic': [],
    'apsiii': ['apsiii_prob'],
    'arb': [],
    'asof_view_before_purchase': ['view_value'],
    'bg': ['so2', 'po2', 'pco2', 'fio2', 'aado2', 'ph', 'baseexcess', 'bicarbonate', 'totalco2', 'hematocrit', 'hemoglobin', 'carboxyhemoglobin', 'methemoglobin', 'chloride', 'calcium', 'temperature', 'potassium', 'sodium', 'lactate', 'glucose', 'fio2_chartevents', 'aado2_calc', 'pao2fio2ratio'],
    'blood_differential': ['wbc', 'basophils_abs', 'eosinophils_abs', 'lymphocytes_abs', 'monocytes_abs', 'neutrophils_abs', 'basophils', 'eosinophils', 'lymphocytes', 'monocytes', 'neutrophils', 'atypical_lymphocytes', 'bands', 'immature_granulocytes', 'metamyelocytes', 'nrbc'],
    'boundary_hour_sums': ['value', 'value_6hr', 'value_12hr'],
    'build_chain': ['heart_rate_min', 'heart_rate_max', 'heart_rate_mean', 'sbp_min', 'sbp_max', 'sbp_mean', 'dbp_min', 'dbp_max', 'dbp_mean', 'mbp_min', 'mbp_max', 'mbp_mean', 'resp_rate_min', 'resp_rate_max', 'resp_rate_mean', 'temperature_min', 'temperature_max', 'temperature_mean', 'spo2_min', 'spo2_max', 'spo2_mean', 'glucose_min', 'glucose_max', 'glucose_mean'],
    'cardiac_marker': ['troponin_t', 'ck_mb', 'ntprobnp'],
    'carry_previous_value': ['value', 'prev_value'],
    'charlson': [],
    'chemistry': ['albumin', 'globulin', 'total_protein', 'aniongap', 'bicarbonate', 'bun', 'calcium', 'chloride', 'creatinine', 'glucose', 'sodium', 'potassium'],
    'coagulation': ['d_dimer', 'fibrinogen', 'thrombin', 'inr', 'pt', 'ptt'],
    'code_status': [],
    'complete_blood_count': ['hematocrit', 'hemoglobin', 'mch', 'mchc', 'mcv', 'platelet', 'rbc', 'rdw', 'rdwsd', 'wbc'],
    'creatinine_baseline': ['scr_min', 'mdrd_est', 'scr_baseline'],
    'crrt': ['access_pressure', 'blood_flow', 'citrate', 'current_goal', 'dialysate_rate', 'effluent_pressure', 'filter_pressure', 'heparin_dose', 'hourly_patient_fluid_removal', 'prefilter_replacement_rate', 'postfilter_replacement_rate', 'replacement_rate', 'return_pressure', 'ultrafiltrate_output'],
    'daily_event_pivot': ['click_max', 'view_avg', 'purchase_cents', 'signup_min', 'error_max'],
    'daily_ratio_and_dose': ['view_imputed', 'weighted_dose'],
    'dobutamine': ['vaso_rate', 'vaso_amount'],
    'dopamine': ['vaso_rate', 'vaso_amount'],
    'enzyme': ['alt', 'alp', 'ast', 'amylase', 'bilirubin_total', 'bilirubin_direct', 'bilirubin_indirect', 'ck_cpk', 'ck_mb', 'ggt', 'ld_ldh'],
    'epinephrine': ['vaso_rate', 'vaso_amount'],
    'episode_first_day_flag': [],
    'event_type_episodes': [],
    'event_type_segments': ['click', 'error', 'purchase', 'signup', 'view'],
    'far_intervals': ['value_max'],
    'first_day_bg': ['lactate_min', 'lactate_max', 'ph_min', 'ph_max', 'so2_min', 'so2_max', 'po2_min', 'po2_max', 'pco2_min', 'pco2_max', 'aado2_min', 'aado2_max', 'aado2_calc_min', 'aado2_calc_max', 'pao2fio2ratio_min', 'pao2fio2ratio_max', 'baseexcess_min', 'baseexcess_max', 'bicarbonate_min', 'bicarbonate_max', 'totalco2_min', 'totalco2_max', 'hematocrit_min', 'hematocrit_max', 'hemoglobin_min', 'hemoglobin_max', 'carboxyhemoglobin_min', 'carboxyhemoglobin_max', 'methemoglobin_min', 'methemoglobin_max', 'temperature_min', 'temperature_max', 'chloride_min', 'chloride_max', 'calcium_min', 'calcium_max', 'glucose_min', 'glucose_max', 'potassium_min', 'potassium_max', 'sodium_min', 'sodium_max'],
    'first_day_bg_art': ['lactate_min', 'lactate_max', 'ph_min', 'ph_max', 'so2_min', 'so2_max', 'po2_min', 'po2_max', 'pco2_min', 'pco2_max', 'aado2_min', 'aado2_max', 'aado2_calc_min', 'aado2_calc_max', 'pao2fio2ratio_min', 'pao2fio2ratio_max', 'baseexcess_min', 'baseexcess_max', 'bicarbonate_min', 'bicarbonate_max', 'totalco2_min', 'totalco2_max', 'hematocrit_min', 'hematocrit_max', 'hemoglobin_min', 'hemoglobin_max', 'carboxyhemoglobin_min', 'carboxyhemoglobin_max', 'methemoglobin_min', 'methemoglobin_max', 'temperature_min', 'temperature_max', 'chloride_min', 'chloride_max', 'calcium_min', 'calcium_max', 'glucose_min', 'glucose_max', 'potassium_min', 'potassium_max', 'sodium_min', 'sodium_max'],
    'first_day_gcs': ['gcs_min', 'gcs_motor', 'gcs_verbal', 'gcs_eyes'],
    'first_day_height': ['height'],
    'first_day_lab': ['hematocrit_min', 'hematocrit_max', 'hemoglobin_min', 'hemoglobin_max', 'platelets_min', 'platelets_max', 'wbc_min', 'wbc_max', 'albumin_min', 'albumin_max', 'globulin_min', 'globulin_max', 'total_protein_min', 'total_protein_max', 'aniongap_min', 'aniongap_max', 'bicarbonate_min', 'bicarbonate_max', 'bun_min', 'bun_max', 'calcium_min', 'calcium_max', 'chloride_min', 'chloride_max', 'creatinine_min', 'creatinine_max', 'glucose_min', 'glucose_max', 'sodium_min', 'sodium_max', 'potassium_min', 'potassium_max', 'abs_basophils_min', 'abs_basophils_max', 'abs_eosinophils_min', 'abs_eosinophils_max', 'abs_lymphocytes_min', 'abs_lymphocytes_max', 'abs_monocytes_min', 'abs_monocytes_max', 'abs_neutrophils_min', 'abs_neutrophils_max', 'atyps_min', 'atyps_max', 'bands_min', 'bands_max', 'imm_granulocytes_min', 'imm_granulocytes_max', 'metas_min', 'metas_max', 'nrbc_min', 'nrbc_max', 'd_dimer_min', 'd_dimer_max', 'fibrinogen_min', 'fibrinogen_max', 'thrombin_min', 'thrombin_max', 'inr_min', 'inr_max', 'pt_min', 'pt_max', 'ptt_min', 'ptt_max', 'alt_min', 'alt_max', 'alp_min', 'alp_max', 'ast_min', 'ast_max', 'amylase_min', 'amylase_max', 'bilirubin_total_min', 'bilirubin_total_max', 'bilirubin_direct_min', 'bilirubin_direct_max', 'bilirubin_indirect_min', 'bilirubin_indirect_max', 'ck_cpk_min', 'ck_cpk_max', 'ck_mb_min', 'ck_mb_max', 'ggt_min', 'ggt_max', 'ld_ldh_min', 'ld_ldh_max'],
    'first_day_rrt': [],
    'first_day_sofa': [],
    'first_day_urine_output': ['urineoutput'],
    'first_day_vitalsign': ['heart_rate_min', 'heart_rate_max', 'heart_rate_mean', 'sbp_min', 'sbp_max', 'sbp_mean', 'dbp_min', 'dbp_max', 'dbp_mean', 'mbp_min', 'mbp_max', 'mbp_mean', 'resp_rate_min', 'resp_rate_max', 'resp_rate_mean', 'temperature_min', 'temperature_max', 'temperature_mean', 'spo2_min', 'spo2_max', 'spo2_mean', 'glucose_min', 'glucose_max', 'glucose_mean'],
    'first_day_weight': ['weight_admit', 'weight', 'weight_min', 'weight_max'],
    'first_four_event_types': [],
    'first_matches_open': [],
    'first_signup_window': ['value_min', 'value_max', 'value_avg', 'value_sum'],
    'gcs': ['gcs', 'gcs_motor', 'gcs_verbal', 'gcs_eyes'],
    'height': ['height'],
    'hourly_spine_minmax': ['value_min', 'value_max'],
    'icp': ['icp'],
    'icustay_detail': ['los_icu'],
    'icustay_hourly': [],
    'icustay_times': [],
    'inflammation': ['crp'],
    'interval_override': ['value'],
    'invasive_line': [],
    'kdigo_creatinine': ['creat', 'creat_low_past_48hr', 'creat_low_past_7day'],
    'kdigo_stages': ['creat_low_past_7day', 'creat_low_past_48hr', 'creat', 'uo_rt_6hr', 'uo_rt_12hr', 'uo_rt_24hr'],
    'kdigo_uo': ['weight', 'urineoutput_6hr', 'urineoutput_12hr', 'urineoutput_24hr', 'uo_rt_6hr', 'uo_rt_12hr', 'uo_rt_24hr', 'uo_tm_6hr', 'uo_tm_12hr', 'uo_tm_24hr'],
    'lineitem_ladders': ['qty_min', 'qty_max', 'disc_max', 'tax_max', 'prob'],
    'lods': [],
    'lookback_min_48h': ['value', 'value_min_48h'],
    'meld': ['creatinine_max', 'bilirubin_total_max', 'inr_max', 'sodium_min', 'meld_initial', 'meld'],
    'merge_click_view': ['value'],
    'milrinone': ['vaso_rate', 'vaso_amount'],
    'neuroblock': ['drug_rate', 'drug_amount'],
    'norepinephrine': ['vaso_rate', 'vaso_amount'],
    'norepinephrine_equivalent_dose': ['norepinephrine_equivalent_dose'],
    'nsaid': [],
    'oasis': ['gcs', 'urineoutput', 'heartrate', 'meanbp', 'resprate', 'temp', 'oasis_prob'],
    'order_meld': ['meld_initial', 'meld'],
    'order_part_flags': [],
    'order_window_events': [],
    'oxygen_delivery': ['o2_flow', 'o2_flow_additional'],
    'part_name_keywords': ['l_quantity'],
    'phenylephrine': ['vaso_rate', 'vaso_amount'],
    'props_clamped_window': [],
    'props_pattern_window': [],
    'purchase_error_match': [],
    'rhythm': [],
    'rrt': [],
    'sapsii': ['sapsii_prob'],
    'sepsis3': [],
    'sirs': [],
    'sofa': ['pao2fio2ratio_novent', 'pao2fio2ratio_vent', 'meanbp_min', 'gcs_min', 'uo_24hr', 'bilirubin_max', 'creatinine_max', 'platelet_min', 'rate_epinephrine', 'rate_norepinephrine', 'rate_dopamine', 'rate_dobutamine'],
    'suspicion_of_infection': [],
    'top_event_per_user': ['value'],
    'top_three_values': ['value'],
    'trailing_rows_max': ['value', 'max_of_5', 'max_of_3_before'],
    'trailing_sums': ['value', 'value_sum_6h', 'value_sum_12h', 'value_sum_24h'],
    'union_event_times': ['click_value', 'view_value'],
    'unit_values': ['value_std'],
    'urine_output': ['urineoutput'],
    'urine_output_rate': ['weight', 'uo', 'uo_mlkghr_6hr', 'uo_tm_6hr', 'urineoutput_6hr', 'uo_mlkghr_12hr', 'uo_tm_12hr', 'urineoutput_12hr', 'uo_mlkghr_24hr', 'uo_tm_24hr', 'urineoutput_24hr'],
    'value_validity': ['value'],
    'vasoactive_agent': ['dopamine', 'epinephrine', 'norepinephrine', 'phenylephrine', 'vasopressin', 'dobutamine', 'milrinone'],
    'vasopressin': ['vaso_rate', 'vaso_amount'],
    'ventilation': [],
    'ventilator_setting': ['respiratory_rate_set', 'respiratory_rate_total', 'respiratory_rate_spontaneous', 'minute_volume', 'tidal_volume_set', 'tidal_volume_observed', 'tidal_volume_spontaneous', 'plateau_pressure', 'peep', 'fio2', 'flow_rate'],
    'vitalsign': ['heart_rate', 'sbp', 'dbp', 'mbp', 'sbp_ni', 'dbp_ni', 'mbp_ni', 'resp_rate', 'temperature', 'spo2', 'glucose'],
    'weekday_quarter_points': [],
    'weight_durations': ['weight'],
}
