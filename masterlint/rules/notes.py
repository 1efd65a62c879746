"""The closing text of each rule's DETAILS."""

# Shown after the counts, leading and trailing spaces included.
NOTES: dict[int, str] = {
    1: "Existencia de materiales duplicados",
    2: "  Validación ramo tipo producto distinto a A",
    3: "Coherencia entre el tipo de material (MTART) y la codificación interna del número de material (MATNR)",
    5: " Asignación correcta del centro según tipo de material",
    6: "  Asignación correcta de almacén",
    7: " Validación campo organización de ventas",
    8: " Validación campo Sector Nulo",
    9: " Validación campo Descripción ES",
    11: " Validación campo Descripción EN",
    12: " Validez del grupo de Artículos ",
    13: " Verificación Unidad Medida Base",
    14: " JERARQUIA: verificamos materiales con jerarquía nula o < a 18 caracteres.",
    15: "Validación de código agrupador",
    16: " Validación código switch",
    17: " Validación material catch weight",
    18: "Validación el campo MTPOS_MARA (Grupo de posición general del material en ventas).",
    19: "Material sin ZZMARCADOR: ",
    20: " Validación indicador de temperatura",
    21: " Validación indicador de movimiento",
    22: "Validación Materiales sin Marca detallada:",
    23: " Validación indicador de posicionamiento",
    24: " Validación del peso escurrido",
    25: " Coherencia entre la Unidad de Medida Base (MEINS) y el indicador VABME (UMP_VAR)",
    26: " Validación del campo indicador frágil",
    27: " Identificar códigos EAN nulos.",
    28: "Coherencia entre EAN, longitud y tipo.",
    29: " Validación Peso bruto definido: ",
    30: " Validación peso neto no nulo ",
    31: "Comprobar si unidad por defecto es KG",
    32: " Validación del campo volumen de los materiales",
    33: " Coherencia en el valor de unidad de volumen",
    34: " Validamos el dato logístico: largo",
    35: " Validamos el dato logístico: ancho",
    36: " Validamos el dato logístico: alto",
    37: " Coherencia en la unidad de dimensión",
    38: " Coherencia en la unidad de medida del contenido",
    39: " Validación de la gestión del material por lote.",
    40: " Validación de la verificación de la disponibilidad del material.",
    41: " Validación del grupo de transporte.",
    42: " Validación del grupo de carga.",
    43: " Validación consistencia entre centro y CEBE.",
    44: " Validación de formato de partida arancelaria (TARIC).",
    45: " Validación del país de origen del material.",
    46: " Validación del grupo de requerimientos para export / import.",
    47: " Validación del campo región.",
    49: " Coherencia entre temperatura del material y su grupo de compras.",
    50: " Validación y control de status de compra.",
    51: " Coherencia entre UMB = ST y unidad de pedido de compra igual a CJ.",
    52: ' Coherencia en el valor de planificación para los centros "virtuales".',
    53: " Validación grupo planificación de necesidades.",
    54: " Validación del número del planificador de necesidades.",
    55: " Validación de la clave que determina el cálculo del tamaño del lote fijando la cantidad de aprovisionamiento. ",
    56: " Validación del tipo de aprovisionamiento, en nuestro caso compra externo.",
    57: " Coherencia entre el centro y el valor de aprovisionamiento especial (centralizado).",
    58: " Coherencia entre el centro y el valor del almacén de aprovisionamiento.",
    60: " Verifica cantidad de días necesarios para verificar y almacenar el material después de recibir la mercancía.",
    61: " Validamos número de días para obtener el material.",
    62: " Validamos la clave que calcula los tiempos de holgura necesarios para la programación de una orden.",
    63: " Validamos el indicador que activa el margen de seguridad.",
    64: " Validamos la configuración de la cantidad de días laborables para el margen de seguridad/cobertura real.",
    65: " Validamos el campo de grupo de posibles estrategias para un material.",
    66: " Validamos el indicador para las condiciones de temperatura para un material.",
    67: " Validamos el indicador que especifíca en que intervalos se consume y pronostica el material.",
    68: " Coherencia en el campo de porcentaje de tolerancia para materiales catch weight.",
    69: " Validación en la relación entre UMB y su conversión para la UMA_2 (unidad de medida alternativa 2).",
    70: " Validación de la UMA_2 (unidad de medida alternativa 2) según el valor de la UMB.",
    71: " Validamos el campo de conversión de cantidad de unidades según el valor de UMB.",
    72: " Validamos el campo EAN de la unidad en aquellos casos que sea posible la venta por UN.",
    73: " Validamos la relación entre código EAN y el tipo de código EAN.",
    74: " Validamos el valor del peso bruto de la umb2.",
    75: " Validamos la unidad del peso bruto de la umb2.",
    76: " Validamos el valor del volumen de la umb2.",
    77: " Validamos el valor de la unidad del volumen de la umb2.",
    78: " Validamos el valor del largo de la umb2.",
    79: " Validamos el valor del ancho de la umb2.",
    80: " Validamos el valor del alto de la umb2.",
    81: " Validamos el valor de la unidad de la umb2.",
    82: " Validamos el valor de los kilogramos de la unidad alternativa 3 (KG).",
    83: " Validamos el valor de la unidad de medida alternativa 4 (PAL).",
    84: " Validamos el valor de la unidad de medida base 4 (PAL) en relación con la umb5(CAP) y en realción a can_umb2 (CJ) o si umb=UN será en relación a can_uma2(UN).",
    85: " Validamos el valor de la cantidad de unidad de medida base 5 (CAP) en relación con la cantidad de umb4(PAL)  y en realción a can_umb2 (CJ) o si umb=UN será en relación a can_uma2(UN).",
    86: " Validamos el valor de la cantidad de unidad de medida alternativa 5 (CAP).",
    87: " Validamos el valor del campo valor de redondeo.",
    88: " Validamos el valor del campo clasificación de materiales según su rotación de stock.",
    89: " Validamos el valor de la categoría de valoración que tendrá impacto en cuentas de mayor tras una operación.",
    90: " Validamos el valor del campo control de precios.",
    91: " Validamos el valor de cantidad base según se basa el precio de valoración.",
    92: " Validamos el valor del grupo de medida, campo que define la posibilidad de vender a la UN y a la CJ o solo a la CJ.",
    93: " Validamos la unicidad en la asignación de códigos en los acreedores.",
    94: " Validamos la obligatoriedad de cumplimentar el campo país.",
    95: " Validamos la obligatoriedad de cumplimentar el campo nombre del proveedor.",
    96: " Validamos la obligatoriedad de cumplimentar el campo nombre2 del proveedor.",
    97: " Validamos la obligatoriedad de cumplimentar el campo población del proveedor.",
    98: " Validamos la obligatoriedad de cumplimentar el campo código postal del proveedor.",
    99: " Validamos la obligatoriedad de cumplimentar el campo región o provincia del proveedor.",
    100: " Validamos que este cumplimentado el campo de búsqueda rápida del proveedor.",
    101: " Validamos que este cumplimentado el campo de dirección del proveedor.",
    102: " Validamos el valor del campo grupo de cuentas del proveedor.",
    105: " Validamos que este cumplimentado el campo de idioma del proveedor..",
    106: " Validamos que este cumplimentado el campo de número de identificación fiscal del proveedor..",
    107: " Validamos que este cumplimentado el campo de número de NIF comunitario del proveedor cuando este no es de origen ES.",
    108: " Validamos que este cumplimentado el campo día de pedido del proveedor.",
    109: " Validamos que este cumplimentado el campo día de pedido del proveedor.",
    110: " Validamos que este marcado con X el campo para el control de facturas basado en entrada de mercancía.",
    111: " Validamos que este campo tenga los valores 001, Z15 y Z12.",
    112: " Validamos que este campo sea igual a Z004.",
    113: " Validamos que este campo sea único.",
    114: " Validamos que el campo del nombre esté cumplimentado.",
    115: " Validamos la obligatoriedad del teléfono de contacto en los contactos comerciales y de emergencias.",
    116: " Validamos la obligatoriedad de una función de contacto para cada persona de contacto.",
    117: " Validamos la obligatoriedad de un idioma asociado para cada persona de contacto.",
    118: " Validamos la obligatoriedad de un correo electrónico para las personas de contacto.",
    119: ' Validamos que cada proveedor tenga las siguientes Funciones de interlocutor ("ZE","EF","DP","PR") y que no tengan la función "ZO".',
    120: ' Validamos que cada función de interlocutor ("ZE","EF","DP","PR") tenga el mismo valor de referencia de proveedor que el acreedor (LIFN2 = LIFNR)',
}
