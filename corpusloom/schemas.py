"""Schemas of the record kinds."""

from __future__ import annotations

SCRIPT = """id string, name string, description string, created_at string, chart_url string, symbol string,
user_info struct<username:string,profile_url:string,pro_plan:boolean>, likes_count int, source_code string, script_url string,
preview_title string, preview_author string, preview_author_url string, preview_created_at string, preview_likes_count int,
preview_comments_count int, crawl_page int, source_url string, is_editors_pick boolean"""
PAIR = "input string, output string"
INSTRUCTION_PAIR = "instruction string, output string"
SEGMENT = "source_id string, segment_key string, input string, output string"
COMPONENTS = "map<string,struct<description:string,code:string>>"
RL_ROW = """data_source string, prompt array<struct<role:string,content:string>>, ability string,
reward_model struct<style:string,ground_truth:string>,
extra_info struct<strategy_id:string,strategy_name:string,created_at:string,reward_score:double>"""
ANALYSIS = """title string, abstract string, main_algorithms struct<algorithms:string>, key_concepts array<string>,
mathematical_models array<string>, implementation_requirements array<string>, evaluation_metrics array<string>,
datasets_mentioned array<string>, high_level_logic string, complexity_analysis string, novelty string"""
BARS = "date date, open double, high double, low double, close double, volume bigint"
