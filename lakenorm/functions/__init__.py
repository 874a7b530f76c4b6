"""lakenorm.functions"""
