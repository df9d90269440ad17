"""cohortspark.functions"""
